"""Exact deduplication in two passes with Bloom filters by hash range.

Pass 1 sends the hash of every text, 8 bytes, to the task of its range, which
fills a bit map: bits hit at least twice.  Pass 2 probes the maps: a hash with a
bit that was hit once only cannot repeat, so its row passes straight through; the
others shuffle on their hash and are grouped exactly.  There are as many ranges
as the rows ask for, 16 bits a row.  Maps are broadcast as many at a time as a
bound allows; where that takes several turns, each looks at the rows of its
ranges alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, with_group

#: Most bytes of maps that are broadcast at a time: those of 2**24 rows at 16 bits a row.
MAX_FILTER_BYTES = 32 << 20
BITS_A_ROW = 16
PROBES = 4
#: A range's map is filled by one task; there are at least so many ranges, so that several do.
LEAST_RANGES_BITS = 6
MAX_RANGE_BITS = 23
#: A task sorts so many hashes at a time by range, and sends them in rows of so many.
SORTED_AT_ONCE = 1 << 20
HASHES_A_ROW = 512


def filter_shape(rows: int, max_bytes: int | None = None) -> tuple[int, int]:
    """Binary logarithms of the number of ranges and of the bits of each range's map.

    Together they have 16 bits a row or more, if `max_bytes` allows for that.
    """
    total = max(16, (rows * BITS_A_ROW - 1).bit_length())
    if max_bytes is not None:
        total = min(total, (max_bytes * 8).bit_length() - 1)
    each = max(0, min(total - LEAST_RANGES_BITS, MAX_RANGE_BITS))
    return total - each, each


def _range_of(x: Column, ranges: int) -> Column:
    """The first bits of hashes, as a number."""
    return F.shiftrightunsigned(x, 64 - ranges) if ranges else F.lit(0).cast("long")


def _positions(x: np.ndarray, each: int) -> np.ndarray:
    """PROBES bit positions of each hash in the map of its range, by double hashing of its last bits."""
    step = (x >> np.uint64(24)) | np.uint64(1)
    return ((x[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64((1 << each) - 1)).astype(np.int64)


def _send(ranges: int):
    """Hashes sorted and packed by range; of equal ones that are sorted together two go."""

    def packed(x: np.ndarray) -> Iterator[pd.DataFrame]:
        x = np.sort(x)
        x = x[np.concatenate((np.ones(min(2, len(x)), dtype=bool), x[2:] != x[:-2]))]
        at = (x >> np.uint64(64 - ranges)) if ranges else np.zeros(len(x), dtype=np.uint64)
        cuts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(x)]))
        cuts = np.concatenate([np.arange(a, b, HASHES_A_ROW) for a, b in zip(cuts[:-1], cuts[1:])] + [[len(x)]]).astype(np.int64)
        for i in range(0, len(cuts) - 1, 1000):
            some = cuts[i : i + 1001]
            yield pd.DataFrame({"range": at[some[:-1]].astype(np.int64), "hashes": [x[a:b].tobytes() for a, b in zip(some[:-1], some[1:])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch["x"].to_numpy().astype(np.uint64))
            n += len(batch)
            if n >= SORTED_AT_ONCE:
                yield from packed(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from packed(np.concatenate(held))

    return run


def _fill(each: int, twice: bool):
    """The map of each range from its hashes, which arrive sorted by range: bits hit at least twice, or once."""

    def filled(at: int, hashes: list[bytes]) -> pd.DataFrame:
        x = np.sort(np.frombuffer(b"".join(hashes), dtype=np.uint64))
        hit = np.sort(_positions(x, each), axis=1)
        # A hash counts once for a bit that two of its own probes hit.
        own = np.concatenate((np.ones((len(hit), 1), dtype=bool), hit[:, 1:] != hit[:, :-1]), axis=1)
        hit, n = np.unique(hit[own], return_counts=True)
        hit = hit[n > 1] if twice else hit
        bits = np.zeros(max(8, 1 << each), dtype=bool)
        bits[hit] = True
        return pd.DataFrame({"range": [at], "map": [np.packbits(bits, bitorder="little").tobytes()]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, hashes = None, []
        for batch in batches:
            for r, h in zip(batch["range"], batch["hashes"]):
                if r != at:
                    if hashes:
                        yield filled(at, hashes)
                    at, hashes = r, []
                hashes.append(h)
        if hashes:
            yield filled(at, hashes)

    return run


def range_maps(hashes: DataFrame, ranges: int, each: int, twice: bool) -> DataFrame:
    """range, map: a row for each range that has hashes, from a column `x` of 64-bit hashes.

    What shuffles is at most the 8 bytes of each hash and its range for each
    packed row; of a hash that a task has many times, two for each run it sorts.
    """
    sent = hashes.select("x").mapInPandas(_send(ranges), "range long, hashes binary")
    return sent.repartition("range").sortWithinPartitions("range").mapInPandas(_fill(each, twice), "range long, map binary")


def _probe(maps: DataFrame, first: int, count: int, ranges: int, each: int):
    """A pandas UDF on hashes of the ranges from `first` on, and the broadcast it reads."""
    width = max(8, 1 << each) // 8
    whole = np.zeros(count * width, dtype=np.uint8)
    for r in maps.filter(F.col("range").between(first, first + count - 1)).collect():  # at most max_bytes
        whole[(r["range"] - first) * width : (r["range"] - first + 1) * width] = np.frombuffer(r["map"], dtype=np.uint8)
    shared = maps.sparkSession.sparkContext.broadcast(whole)

    @F.pandas_udf("boolean")
    def test(x: pd.Series) -> pd.Series:
        x = x.to_numpy().astype(np.uint64)
        at = (x >> np.uint64(64 - ranges)).astype(np.int64) - first if ranges else np.zeros(len(x), dtype=np.int64)
        bit = _positions(x, each)
        hit = (shared.value[at[:, None] * width + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=1))

    return test, shared


def marked(rows: DataFrame, hashed: Column, name: str, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Staged `rows` with `again`: false only for those whose hash stands once in them.

    `hashed` is any column that is equal where rows are copies and never null.
    `rows` should be staged and narrow, as they are read once to fill the maps and
    once for each `max_bytes` of maps, one for 2**24 rows at the default.  However
    many rows there are, at most one in a hundred that stand once is marked.
    """
    rows = rows.withColumn("_x", F.xxhash64(hashed))
    ranges, each = filter_shape(rows.count())
    each_bytes = max(8, 1 << each) // 8
    at_once = max(1, min(1 << ranges, max_bytes // each_bytes))
    maps = staged(range_maps(rows.select(F.col("_x").alias("x")), ranges, each, twice=True), f"{name}-maps")
    turns = []
    for first in range(0, 1 << ranges, at_once):
        test, shared = _probe(maps, first, at_once, ranges, each)
        some = rows if at_once == 1 << ranges else rows.filter(_range_of(F.col("_x"), ranges).between(first, first + at_once - 1))
        turns.append(staged(some.withColumn("again", test("_x")).drop("_x"), f"{name}-{first}"))
        shared.destroy()
    return reduce(DataFrame.unionByName, turns)


def may_be_among(ids: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Callable[[Column], Column]:
    """A test of 64-bit hashes: false only for those that are not in the column `h` of `ids`.

    The test goes to every task, so it has a bound: beyond 2**24 rows of `ids` at
    the default it tells less, and its false alarms have to be right for the caller.
    """
    ranges, each = filter_shape(ids.count(), max_bytes)
    test, _ = _probe(range_maps(ids.select(F.xxhash64("h").alias("x")), ranges, each, twice=False), 0, 1 << ranges, ranges, each)
    return lambda h: test(F.xxhash64(h))


def hash_of(digest: str) -> Column:
    """The first 60 bits of a column of hexadecimal digests, as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Groups of equal texts: id, keep_id, group_size, kept, text_sha256.

    Every row of `docs` gives one row.  Null texts count as empty, texts are
    compared whole and unchanged.  The row with the largest id stays; among
    repeated rows with that id all are marked kept.  A null id is never the
    largest unless a group has no other; keep_id is then null and kept true.
    An empty table gives none.  Other columns of `docs` are not looked at.
    """
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    hashed = staged(docs.select(F.col(id_col).alias("id"), sha.alias("sha")), "exact-hashes")
    rows = marked(hashed, F.col("sha"), "exact-marked", max_filter_bytes)
    alone = rows.filter(~F.col("again")).select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    again = rows.filter("again").select("id", "sha")
    groups = staged(again.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), "exact-groups")
    grouped = with_group(again, groups, "sha", "group_size").select("id", "sha", "keep_id", "group_size")
    out = alone.unionByName(grouped)
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )
