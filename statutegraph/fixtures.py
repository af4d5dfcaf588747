"""Statute-like views over the synthetic tables, for queries() and bench.py."""

from __future__ import annotations

import csv
import io
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .operators import articles as art
from .sources.exports import ARTICLE_HEADER
from .storage import dealt

#: Relation of a triplet by return flag and line status.
LABELS = (("AF", "정의함"), ("AO", "간주함"), ("NF", "요구함"), ("NO", "금지함"), ("RF", "허용함"))
#: Phrase by line number modulo 8; at 1 a citation stands, of a form that the number gives.
PLANTED = (
    (2, " 「상법」에 따른"),
    (3, " “용어”이란"),
    (4, " 하여야 한다"),
    (5, " 해서는 아니 된다"),
    (6, " 할 수 있다"),
    (7, " 로 본다"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt to all cores where their files give fewer partitions than that: what follows is work of the processor.

    A large table has more partitions than cores and stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def statutes_of(docs: DataFrame) -> DataFrame:
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    content = F.concat_ws("\n\n", F.transform(lines, lambda x, i: F.concat(F.lit("제"), i + 1, F.lit("조 "), x)))
    law = F.concat(F.lit("법률 제"), "doc_id", F.lit("호"))
    return docs.select("doc_id", F.col("doc_id").alias("load_seq"), F.col("source").alias("title"), law.alias("law_number"), content.alias("content"))


def legal_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose lines are articles; titles (the source) repeat on purpose."""
    return statutes_of(spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))


def planted_citation(n: Column) -> Column:
    branch, item = F.when(n % 16 == 1, "의2").otherwise(""), F.when(n % 3 == 0, F.concat(F.lit("제"), n % 5 + 1, F.lit("호"))).otherwise("")
    return F.concat(F.lit(" 제"), n % 9 + 1, F.lit("조"), branch, F.lit("제"), n % 4 + 1, F.lit("항"), item, F.lit("에 따라"))


def planted_of(docs: DataFrame) -> DataFrame:
    lines = F.split(F.coalesce("text", F.lit("")), "\n")

    def line(x, i):
        n = i + 1
        phrase = F.when(n % 8 == 1, planted_citation(n)).otherwise("")
        for k, words in PLANTED:
            phrase = F.when(n % 8 == k, words).otherwise(phrase)
        return F.concat(F.lit("제"), n, F.lit("조(제목"), n, F.lit(") "), x, phrase)

    return docs.select("doc_id", F.concat_ws("\n\n", F.transform(lines, line)).alias("content"))


def planted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with titled headings and a phrase on most articles."""
    return planted_of(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def citing_statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statutes of a few titles, in versions, that cite articles of each other by title, some of none that is there."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    title = lambda n: F.concat(F.lit("법률"), n % 7)
    lines = F.split(F.coalesce("text", F.lit("")), "\n")

    def line(x, i):
        n = i + 1
        law = F.when(n % 5 == 0, F.lit("없는 법")).otherwise(title(F.col("doc_id") + n))
        named = F.concat(F.lit(" 제1조 및 「"), law, F.lit("」 제"), n % 9 + 1, F.lit("조제1항, 제 "), n % 40 + 1, F.lit(" 조에 따라"))
        return F.concat(F.lit("제"), n, F.lit("조(제목"), n, F.lit(") "), x, F.when(n % 3 == 1, named).otherwise(""))

    return docs.select("doc_id", F.col("doc_id").alias("load_seq"), title(F.col("doc_id")).alias("title"), F.concat_ws("\n\n", F.transform(lines, line)).alias("content"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles numbered 1 to 5 in turn, so that numbers repeat within a document."""
    pieces = art.articles(legal_documents(spark, sf_dir), keep=("load_seq",))
    number = F.concat(F.lit("제"), F.col("pos") % 5 + 1, F.lit("조"))
    return pieces.select("doc_id", "load_seq", "pos", number.alias("article_number"), F.substring("article_text", 1, 20).alias("concept"), "article_text")


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triplets with few subjects and objects, so that keys and confidences tie; orders are dealt to the documents."""
    documents = table(spark, sf_dir, "documents").count()  # from the footers
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = table(spark, sf_dir, "lineitem")
    rows = dealt(rows.withColumn("doc_id", F.col("l_orderkey") % F.lit(max(1, documents))), rows.count(), "doc_id")
    pos = F.row_number().over(W.partitionBy("doc_id").orderBy(*order)) - 1
    relation = F.lit("참조함")
    for flag, label in LABELS:
        relation = F.when(F.concat("l_returnflag", "l_linestatus") == flag, label).otherwise(relation)
    return rows.select(
        "doc_id",
        pos.cast("long").alias("pos"),
        F.concat(F.lit("S"), F.col("l_suppkey") % 5).alias("subject"),
        relation.alias("relation"),
        F.concat(F.lit("P"), F.col("l_partkey") % 10).alias("object"),
        F.concat(F.lit("제"), "l_linenumber", F.lit("조")).alias("article_number"),
        F.round(F.col("l_discount").cast("double") * 10, 1).alias("confidence"),
    )


def triplet_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triplets as answers of an extractor, good and bad by position."""
    rows = triplets(spark, sf_dir)
    whole = F.to_json(F.struct("subject", "relation", "object", "article_number", "confidence"))
    bare = F.to_json(F.struct("subject", "relation", "object", "article_number"))
    numeric = F.to_json(F.struct(F.lit(5).alias("subject"), "relation", "object", "article_number", "confidence"))
    k = F.col("pos") % 6
    answer = (
        F.when(k == 0, whole)
        .when(k == 1, F.concat(F.lit("```json\n["), whole, F.lit("]\n```")))
        .when(k == 2, F.concat(F.lit("["), whole, F.lit(', "x"]')))
        .when(k == 3, F.concat(F.lit("["), bare, F.lit("]")))
        .when(k == 4, numeric)
        .otherwise(F.lit("no answer {"))
    )
    return rows.select("doc_id", "pos", answer.alias("response"))


def entity_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with an extractor's answer, good and bad by position."""
    rows = articles(spark, sf_dir)
    whole = F.to_json(F.struct("article_number", "concept", F.lit("주체").alias("subject"), F.col("concept").alias("full_text")))
    k = F.col("pos") % 4
    answer = F.when(k == 0, whole).when(k == 1, F.concat(F.lit("["), whole, F.lit(", 1]"))).when(k == 2, F.to_json(F.struct("article_number"))).otherwise(F.lit("{"))
    return rows.select("doc_id", "pos", "article_text", answer.alias("response"))


def pages_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return rows.select(
        F.concat(F.lit("/"), "conv_id", F.lit(".pdf")).alias("path"), F.col("turn").cast("int").alias("page_num"), F.when(F.col("turn") % 3 == 2, F.lit(" \n")).otherwise(F.col("text")).alias("text")
    )


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with markers inside, and markers that begin on one page and end on another, with a blank one between in places."""
    n = F.col("turn")
    text = F.coalesce("text", F.lit(""))
    told = (
        F.when(n % 4 == 0, F.concat(F.lit("머리 "), text, F.lit(" 제 ")))
        .when(n % 4 == 1, F.concat(n, F.lit(" 조 "), text, F.lit(" 제"), n, F.lit("조의2 끝 제7")))
        .when(n % 4 == 2, F.when(F.col("conv_id") % 2 == 0, F.lit(" \n")).otherwise(F.lit(" 3 ")))
        .otherwise(F.concat(F.lit("조(제목) "), text))
    )
    rows = table(spark, sf_dir, "conversations")
    return rows.select(F.concat(F.lit("/"), "conv_id", F.lit(".pdf")).alias("path"), n.cast("int").alias("page_num"), told.alias("text"))


def meta_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the files: empty titles and subjects by number, every eleventh unreadable."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").cast("int").alias("pages"))
    n = F.col("conv_id")
    return rows.select(
        F.concat(F.lit("/"), n, F.lit(".pdf")).alias("path"),
        F.when(n % 3 == 0, F.concat(F.lit("제목"), n)).otherwise(F.lit("")).alias("title"),
        F.lit("").alias("author"),
        F.when(n % 3 == 1, F.concat(F.lit("주제"), n)).alias("subject"),
        "pages",
        F.concat(n, F.lit(".pdf")).alias("filename"),
        F.when(n % 11 == 10, F.lit("unreadable")).alias("error"),
    )


def write_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """A file of each conversation's texts, named .pdf, .PDF or, every third, .txt; written by the tasks."""

    def write(batches):
        for batch in batches:
            fs, root = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
            fs.create_dir(root, recursive=True)
            for n, texts in zip(batch["conv_id"], batch["texts"]):
                kind = "txt" if n % 3 == 0 else "pdf" if n % 2 == 0 else "PDF"
                with fs.open_output_stream(f"{root}/{n}.{kind}") as out:
                    out.write("".join(texts).encode())
            yield batch[["conv_id"]]

    texts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("texts"))
    texts.mapInPandas(write, "conv_id long").write.format("noop").mode("overwrite").save()


def write_foreign_listing(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """An article listing as another program writes it: byte-order mark, quotes only where needed, line breaks and doubled quotes inside, empty fields."""

    def write(batches):
        for k, batch in enumerate(batches):
            fs, root = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{uuid.uuid4().hex}-{k}.csv") as out:
                text = io.StringIO()
                rows = csv.writer(text, lineterminator="\n")
                rows.writerow(ARTICLE_HEADER)
                for title, n, role, body in zip(batch["title"], batch["turn"], batch["role"], batch["text"]):
                    rows.writerow([title, f"제{n}조", f'{role}, "{n}"', "", role if n % 2 else "", "", body])
                out.write(b"\xef\xbb\xbf" + text.getvalue().rstrip("\n").encode())
            yield batch[["turn"]]

    rows = table(spark, sf_dir, "conversations").select(F.concat(F.lit("법률 "), "conv_id").alias("title"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows.mapInPandas(write, "turn long").write.format("noop").mode("overwrite").save()
