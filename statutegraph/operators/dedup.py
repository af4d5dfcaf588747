"""Triplet deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("doc_id", "subject", "relation", "object")


def dedup_triplets(triplets: DataFrame, min_confidence: float | None = None) -> DataFrame:
    """One triplet for each document, subject, relation and object: that of the highest confidence.

    Ties keep the earliest.  A NaN never replaces another and, standing first,
    is never replaced.  `first_pos` is where the key first stood.
    The winners are found by aggregates that combine before the shuffle; as they hold
    strings, Spark sorts by the key for them.  A confidence threshold applies only if
    asked for.
    """
    rows = triplets if min_confidence is None else triplets.filter(F.col("confidence") >= min_confidence)
    rest = F.struct("article_number", "confidence", "pos")
    strength = F.struct(~F.isnan("confidence"), F.col("confidence"), -F.col("pos"))
    grouped = rows.groupBy(*KEY).agg(F.max_by(rest, strength).alias("best"), F.min_by(rest, F.col("pos")).alias("first"))
    kept = F.when(F.isnan("first.confidence"), F.col("first")).otherwise(F.col("best"))
    return grouped.withColumn("kept", kept).select(*KEY, "kept.article_number", "kept.confidence", "kept.pos", F.col("first.pos").alias("first_pos"))
