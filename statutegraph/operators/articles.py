"""Documents to articles and what hangs on their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as t


def articles(docs: DataFrame, mode: str = "citation", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, pos, article_text for each article; the content itself goes no further."""
    return docs.select("doc_id", *keep, F.posexplode(t.split_articles(F.col("content"), mode)).alias("pos", "article_text")).withColumn("pos", F.col("pos").cast("long"))


#: Numbers of an array that are added up one by one; longer arrays go by runs of so many.
RUN = 64


def _sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it, by plain steps."""
    return F.transform(numbers, lambda x, i: F.aggregate(F.slice(numbers, F.lit(1), i), F.lit(0).cast("long"), lambda a, y: a + y))


def offsets(docs: DataFrame) -> DataFrame:
    """doc_id, pos, start, end of each article in the content, in characters.

    `end` is where the next article begins, or the end of the content.  All sums
    are taken within the document's row, by runs of pieces, so nothing shuffles.
    """
    rows = docs.select("doc_id", t.raw_pieces(F.col("content")).alias("p"))
    rows = rows.select("doc_id", F.transform("p", lambda x: F.length(x).cast("long")).alias("n"), F.transform("p", lambda x: t.begins_article(x)).alias("starts"))
    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size("n") / F.lit(RUN)).cast("int") - 1), lambda k: F.slice("n", k * RUN + 1, F.lit(RUN)))
    rows = rows.select("doc_id", "n", "starts", runs.alias("runs"))
    totals = F.transform("runs", lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda a, y: a + y))
    empty = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("all"))
    before = F.aggregate(totals, empty, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")), lambda a: a["all"])
    rows = rows.select("doc_id", "n", "starts", "runs", before.alias("before"))
    at = F.flatten(F.zip_with("runs", "before", lambda r, b: F.transform(_sums_before(r), lambda x: x + b)))
    rows = rows.select("doc_id", F.arrays_zip(at.alias("start"), F.col("n"), F.col("starts")).alias("p"), F.exists("starts", lambda x: x).alias("some"))
    # Without any marker the one piece is the article.
    found = rows.select("doc_id", F.posexplode(F.filter("p", lambda x: x["starts"] | ~F.col("some"))).alias("pos", "a"))
    return found.select("doc_id", F.col("pos").cast("long").alias("pos"), "a.start", (F.col("a.start") + F.col("a.n")).alias("end"))


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id, chars of the rejoined content, articles: array work within the row, done once, no shuffle."""
    rows = docs.select("doc_id", t.clean_text(F.col("content")).alias("_clean"))
    rows = rows.select("doc_id", t.split_articles(F.col("_clean")).alias("_pieces"))
    return rows.select("doc_id", F.length(F.concat_ws("\n\n", "_pieces")).cast("long").alias("chars"), F.size("_pieces").cast("long").alias("articles"))


def with_counts(docs: DataFrame, entities: DataFrame, triplets: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """metrics() with the numbers of entities and triplets, and of `pages` (doc_id, pages) if given, 0 where there are none."""
    out = metrics(docs)
    for name, rows in (("entities", entities), ("triplets", triplets)):
        out = out.join(rows.groupBy("doc_id").agg(F.count("*").alias(name)), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    if pages is not None:
        out = out.join(pages.select("doc_id", "pages"), "doc_id", "left").withColumn("pages", F.coalesce("pages", F.lit(0)))
    return out


def numbered(pieces: DataFrame) -> DataFrame:
    """Articles with their number and its parts; null where the text begins with none."""
    number = t.article_number(F.col("article_text"))
    return pieces.withColumn("article_number", number).withColumn("parts", t.number_parts(F.col("article_number")))


#: Records of one document that one task puts in order.
CHUNK = 1 << 16


def context(entities: DataFrame, size: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Each record with the lines of up to `size` records before it in its document.

    A line is "- number: concept"; without any record before it a fixed word stands.
    A document of more than `chunk` records is dealt to several tasks, each with the
    last `size` records before its own; positions are taken to be without gaps, as
    articles() gives them.
    """
    line = F.concat(F.lit("- "), F.col("article_number"), F.lit(": "), F.col("concept"))
    own = F.floor(F.col("pos") / chunk)
    sent = F.when(F.pmod("pos", F.lit(chunk)) >= chunk - size, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = entities.withColumn("_chunk", F.explode(sent))
    before = W.partitionBy("doc_id", "_chunk").orderBy("pos").rowsBetween(-size, -1)
    out = dealt.withColumn("context", t.or_default(F.concat_ws("\n", F.collect_list(line).over(before)), t.NO_CONTEXT))
    return out.filter(F.col("_chunk") == own).drop("_chunk")


def first_rows(rows: DataFrame, n: int = 10, key: str = "doc_id", order: str = "pos") -> DataFrame:
    """The first `n` rows of each document, in document order."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def first_articles(pieces: DataFrame, n: int = 3) -> DataFrame:
    """The first `n` articles of each document: positions count from 0, so nothing shuffles."""
    return pieces.filter(F.col("pos") < n)


def entity_prompt(article_text: Column, instruction: str = "다음 조문의 번호, 개념, 주체, 행위, 대상을 JSON으로 답하라.") -> Column:
    return F.concat(F.lit(f"{instruction}\n\n"), article_text)


def relation_prompt(entity: DataFrame, instruction: str = "다음 기록의 관계를 JSON 배열로 답하라.") -> Column:
    """A prompt of a record's six fields and its context; empty optional fields are named as not given."""
    parts: list[Column] = [F.lit(instruction)]
    for label, name in (("조항", "article_number"), ("개념", "concept"), ("주체", "subject"), ("행위", "action"), ("대상", "object"), ("원문", "full_text"), ("앞 조항", "context")):
        value = t.or_default(entity[name], t.NOT_GIVEN) if name in ("subject", "action", "object") else entity[name]
        parts.append(F.concat(F.lit(f"{label}: "), value))
    return F.concat_ws("\n", *parts)


def shown_entities(entities: DataFrame, n: int = 10) -> DataFrame:
    """What a listing shows of the first records of each document."""
    return first_rows(entities, n).select(
        "doc_id", "pos", "article_number", F.substring("concept", 1, 30).alias("concept"), t.or_default(F.col("subject"), t.DASH).alias("subject"), t.or_default(F.col("action"), t.DASH).alias("action")
    )


def shown_triplets(triplets: DataFrame, n: int = 10) -> DataFrame:
    """What a listing shows of the first triplets of each document; confidence with two digits, halves up."""
    return first_rows(triplets, n).select(
        "doc_id", "pos", F.substring("subject", 1, 20).alias("subject"), "relation", F.substring("object", 1, 20).alias("object"), F.format_string("%.2f", F.col("confidence")).alias("confidence")
    )
