"""Listings as CSV and TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The headers of the two listings.
ARTICLE_HEADER = ("d.title", "a.number", "a.concept", "a.subject", "a.action", "a.object", "a.full_text")
ARTICLE_COLUMNS = ("title", "article_number", "concept", "subject", "action", "object", "full_text")
EDGE_HEADER = ("주체", "관계유형", "대상")
EDGE_COLUMNS = ("subject", "relation", "object")
#: White space at the ends of values is part of them, on the way out and in.
_WHOLE = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """An article listing: UTF-8 with or without byte-order mark, quoted commas and newlines, empty is null."""
    schema = ", ".join(f"`{c}` string" for c in ARTICLE_HEADER)
    rows = spark.read.schema(schema).options(multiLine=True, enforceSchema=True, **_WHOLE).csv(path)
    return rows.toDF(*ARTICLE_COLUMNS)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in EDGE_HEADER)
    return spark.read.schema(schema).options(sep="\t", **_WHOLE).csv(path).toDF(*EDGE_COLUMNS)


def write_articles(listing: DataFrame, path: str) -> None:
    rows = listing.select(*(F.col(c).alias(h) for c, h in zip(ARTICLE_COLUMNS, ARTICLE_HEADER)))
    rows.write.options(**_WHOLE).csv(path)


def write_edges(edges: DataFrame, path: str) -> None:
    edges.select(*(F.col(c).alias(h) for c, h in zip(EDGE_COLUMNS, EDGE_HEADER))).write.options(sep="\t", **_WHOLE).csv(path)
