"""Sharding by Hilbert-curve order of metadata.

Several columns are quantised to a few bits each, the cell's index along the
Hilbert curve orders the rows, and the order is cut into runs of equal row
counts.  Neighbours on the curve are neighbours in every dimension, so a run
spans a small box of each column and a reader prunes by minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attached, ranked, row_key, staged

BITS = 6


def magnitude(size: Column) -> Column:
    """A monotone code of a count: twice its binary exponent plus the next bit, 0 to 63."""
    n = F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)) + F.lit(1)
    exponent = F.length(F.bin(n)) - F.lit(1)
    half = F.substring(F.bin(n), 2, 1)
    return F.least(exponent * 2 + F.when(half == "1", 1).otherwise(0), F.lit((1 << BITS) - 1))


def ordinal_codes(values: DataFrame, name: str) -> DataFrame:
    """Distinct values of the only column with codes 0 to 63 by their order, nulls last."""
    (column,) = values.columns
    order, total = ranked(values.distinct(), [F.col(column).asc_nulls_last()], name)
    return order.select(column, F.floor(F.col("_rank") * F.lit(1 << BITS) / F.lit(max(1, total))).cast("int").alias("_code"))


def with_hilbert_index(df: DataFrame, dims: list[str], bits: int = BITS, out: str = "_curve") -> DataFrame:
    """Adds the index along the Hilbert curve of the integer columns `dims` (0 to 2**bits - 1).

    The axes are turned and reflected from the highest bit down, then Gray coded,
    and their bits interleaved.  Each step is a projection of its own, so that no
    expression is copied into the next.
    """
    x = [f"_x{i}" for i in range(len(dims))]
    df = df.withColumns({x[i]: F.col(d).cast("long") for i, d in enumerate(dims)})
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(len(dims)):
            swap = (F.col(x[0]).bitwiseXOR(F.col(x[i]))).bitwiseAND(F.lit(low))
            set_ = F.col(x[i]).bitwiseAND(F.lit(bit)) != 0
            first = F.when(set_, F.col(x[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(x[0]).bitwiseXOR(swap) if i else F.col(x[0]))
            df = df.withColumns({x[0]: first} if i == 0 else {x[0]: first, x[i]: F.when(set_, F.col(x[i])).otherwise(F.col(x[i]).bitwiseXOR(swap))})
    for i in range(1, len(dims)):
        df = df.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    turn = F.lit(0).cast("long")
    for b in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("_turn", turn).withColumns({c: F.col(c).bitwiseXOR(F.col("_turn")) for c in x})
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(len(dims)):
            at = b * len(dims) + len(dims) - 1 - i
            index = index.bitwiseOR(F.shiftleft(F.shiftright(F.col(x[i]), b).bitwiseAND(F.lit(1).cast("long")), at))
    return df.withColumn(out, index).drop("_turn", *x)


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long")


def checksum_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Every row's place: id, size, text_crc32, law, shard, slot, grown_shard, curve.

    Law `rows`: shards take runs of the curve whose counts are at most one apart,
    the first ones the larger.  Rows of one cell follow by id, checksum, size and
    place in the input, so that a cell with a third of all rows is cut like any other.  Dimensions:
    the columns `dims` by the order of their values (nulls last) and the magnitude
    of the size.  A null text has size 1 and checksum 0; repeated rows get slots
    of their own; an empty table gives none; fewer rows than shards fill the
    first.  Other columns are not looked at.  No Python runs on the executors.
    Texts are read once, for size and checksum.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        size_of(F.col(text_col)).alias("size"),
        checksum_of(F.col(text_col)).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
        *(F.col(d).cast("string").alias(f"_d{i}") for i, d in enumerate(dims)),
    )
    rows = staged(rows, "shard-sizes")
    for i in range(len(dims)):
        codes = ordinal_codes(rows.select(F.col(f"_d{i}").alias("_v")), f"codes-{i}")
        rows = rows.join(codes, F.col(f"_d{i}").eqNullSafe(F.col("_v")), "left").drop(f"_d{i}", "_v").withColumnRenamed("_code", f"_c{i}")
    rows = with_hilbert_index(rows.withColumn("_size", magnitude(F.col("size"))), [*(f"_c{i}" for i in range(len(dims))), "_size"])
    rows = rows.select("doc_id", "size", "text_crc32", "tie", F.col("_curve").alias("curve"))
    placed, total = ranked(rows, [F.col("curve"), F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size"), F.col("tie")], "hilbert")
    few, more = divmod(total, shards)
    wide = more * (few + 1)  # rows of the larger shards
    r = F.col("_rank")
    shard = F.when(r < wide, F.floor(r / F.lit(few + 1))).otherwise(F.lit(more) + F.floor((r - wide) / F.lit(max(1, few))))
    slot = F.when(r < wide, r % F.lit(few + 1)).otherwise((r - wide) % F.lit(max(1, few)))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def sharded(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Whole rows of `docs` as the struct `doc` with `shard`, `slot` and `curve`, laid out in that order.

    Nulls, empty and very long texts, ties, repeated rows and empty tables are as
    in hilbert_shards(); columns of `docs` may have any name, as they travel in
    the struct.
    """
    placed = hilbert_shards(docs, shards, id_col, text_col, **how)
    own = row_key(F.col(id_col), size_of(F.col(text_col)), checksum_of(F.col(text_col)))
    rows = attached(docs, own, placed, row_key(F.col("doc_id"), F.col("size"), F.col("text_crc32")), F.struct("shard", "slot", "curve"))
    rows = rows.select("doc", "got.shard", "got.slot", "got.curve")
    return rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """Rows with a column `shard` as Parquet, a folder for each shard: no file straddles two."""
    placed.write.partitionBy("shard").parquet(path)
