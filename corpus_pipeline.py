"""The corpus pipeline: documents to sharded training text, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statutegraph.llm import decontam, langid, mixing, neardup, sharding
from statutegraph.llm.common import staged

#: SQL cannot express the fingerprints, the language model or the digests' order; tests hold stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows stay; those without a letter or far from every codeword go.

    Null and empty texts go; a null language teaches nothing; very long texts are
    looked at whole; ambiguous ones stay; repeated rows are judged alike; an empty
    table gives none; columns may have any name.
    """
    return langid.in_a_language(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id.

    Rows with a null id stay; null, empty and wordless texts are copies of each
    other; very long texts are compared whole; of rows that repeat id and text one
    stays, of texts under one id that of the smallest digest; an empty table gives
    none; columns may have any name.
    """
    return neardup.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go.

    Null and empty texts contain nothing; very long ones are searched whole;
    repeated rows go or stay alike; an empty table gives none, and an empty
    benchmark leaves all; columns may have any name.
    """
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as the mix takes them, in training order.

    A null source is one source; texts without a word, null ones too, are not
    taken; very long ones are taken like others; ties in position follow by id;
    repeated rows count each; an empty table gives none; columns may have any name.
    """
    return mixing.training_order(docs, whole=True).select("doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard, slot and curve index along the Hilbert curve.

    Nulls come last in each dimension; a null text has size 1; very long ones are
    placed by size like others; ties follow by id, checksum and size; repeated
    rows get slots of their own; an empty table gives none.  Columns of the
    documents stay: where one is named like a new one, the new one gets a trailing
    underscore.
    """
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in ("shard", "slot", "curve"):
        while name in taken:
            name += "_"
        names.append(name)
    placed = sharding.sharded(docs).toDF("doc", *names)
    return placed.select("doc.*", *names)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over `documents`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
