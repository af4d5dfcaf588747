"""Running sums, and other running aggregates, that no single key forces into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import kept

#: Runs of the order column that a key's rows are dealt to.
CHUNKS = 128


def chunk_of(order: str, bounds: list[int]) -> Column:
    """How many of the ascending `bounds` are no greater than the order, by halving."""

    def among(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(F.col(order) < F.lit(bounds[mid]), among(a, mid)).otherwise(among(mid + 1, b))

    return among(0, len(bounds))


def chunk_bounds(orders: DataFrame, order: str, chunks: int = CHUNKS) -> list[int]:
    """Values that part a column of integers into runs of about as many rows, however they are spread."""
    found = orders.agg(F.approx_percentile(order, [i / chunks for i in range(1, chunks)], 20 * chunks).alias("b")).first()["b"]
    return sorted(set(found or []))


def running(rows: DataFrame, key: str, order: str, value: str, out: str, bounds: list[int], function=F.sum, start=None) -> DataFrame:
    """Distinct (key, order) with `function` of `value` over all rows of the key up to that order.

    `function` is a sum, minimum or maximum.  Rows are first aggregated by key and
    order, then within chunks of the order that `bounds` part, then over the chunks
    before, of which a key has as many as there are bounds at most.  So a key that stands in
    every document is spread over tasks, whatever its orders are.
    """
    sums = rows.groupBy(key, order).agg(function(value).alias("_s")).withColumn("_c", chunk_of(order, bounds))
    within = function("_s").over(W.partitionBy(key, "_c").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    before = function("_t").over(W.partitionBy(key).orderBy("_c").rowsBetween(W.unboundedPreceding, -1))
    chunks = sums.groupBy(key, "_c").agg(function("_s").alias("_t")).select(key, "_c", before.alias("_b"))
    both = F.col("_b") + F.col("_w") if function is F.sum else (F.greatest if function is F.max else F.least)("_b", "_w")
    return sums.withColumn("_w", within).join(chunks, [key, "_c"]).select(key, order, F.coalesce(both, "_w", "_b").alias(out))


def running_sum(rows: DataFrame, key: str, order: str, value: str, out: str, bounds: list[int] | None = None) -> DataFrame:
    """running() for sums; the bounds, if not given, come from the rows."""
    return running(rows, key, order, value, out, chunk_bounds(rows, order) if bounds is None else bounds)


def numbered(rows: DataFrame, order: str, out: str) -> DataFrame:
    """Rows with numbers that ascend with `order`, not without gaps, written once so that they stay; one range shuffle."""
    return kept(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn(out, F.monotonically_increasing_id()), "numbered")
