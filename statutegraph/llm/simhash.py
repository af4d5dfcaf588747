"""SimHash near-duplicates by tiled exact comparison.

Fingerprints within `radius` bits are linked, all of them.  Rows meet in
buckets: two fingerprints that differ in r bits agree in at least b - r of b
blocks of bits, so each choice of b - r blocks keys a table and no link is
missed.  The more fingerprints there are, the more blocks, so that keys have
about as many bits as the number of fingerprints and buckets stay small.
Within a bucket, sorted by population count, tiles are compared with numpy's
exclusive-or and bit counts; pairs of tiles whose population counts differ by
more than the radius are never formed.  A bucket beyond one tile is dealt to
several tasks as pairs of tiles.  What leaves a tile is a spanning forest of its
links, never all pairs; components follow by star contraction.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged, with_group

SEED = 42
WORDS = 3
RADIUS = 3
#: Rows of a bucket that one task compares at once.
TILE = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16

_xxh64 = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as an unsigned number: bits set in over half the shingle hashes; no word: 0."""
    w = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z, and white space 20 and 09 to 0D
    if not w:
        return 0
    shingles = zip(*(w[i:] for i in range(words))) if len(w) >= words else iter([w])
    n = max(1, len(w) - words + 1)
    hashes = map(_xxh64, map(b" ".join, shingles))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        h = np.fromiter(itertools.islice(hashes, CHUNK), dtype="<u8", count=min(CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(words: int = WORDS):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return of


def blocks_for(n: int, radius: int) -> int:
    """The least number of blocks, radius + 2 or more, whose keys have as many bits as the number n."""
    blocks = radius + 2
    while 64 * (blocks - radius) // blocks < min(48, max(n, 1).bit_length()):
        blocks += 1
    return blocks


def block_masks(radius: int, blocks: int | None = None) -> list[int]:
    """A mask for each choice of all but `radius` of the blocks of the 64 bits, as signed numbers."""
    blocks = blocks or radius + 2
    cuts = np.linspace(0, 64, blocks + 1).round().astype(int)
    each = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(cuts[:-1], cuts[1:])]
    masks = [sum(chosen) for chosen in itertools.combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item of its component under the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    return root


def tile_links(fp: np.ndarray, pop: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of rows sorted by group and population count, as two index arrays.

    side: 0 within one tile; where a group joins two tiles (1 and 2), rows of the
    same tile have been compared elsewhere.  For each distance in the order all
    groups are compared at once, until no pair of rows is close enough in count.
    """
    a, b = [], []
    alive = np.arange(len(fp))
    for d in range(1, len(fp)):
        alive = alive[alive + d < len(fp)]
        j = alive + d
        near = (group[alive] == group[j]) & (pop[j] - pop[alive] <= radius)
        alive = alive[near]
        if not len(alive):
            break
        j = alive + d
        hit = (np.bitwise_count(fp[alive] ^ fp[j]) <= radius) & ((side[alive] == 0) | (side[alive] != side[j]))
        a.append(alive[hit])
        b.append(j[hit])
        if d & 63 == 0:  # keep a forest, not all links
            a, b = forest(len(fp), np.concatenate(a), np.concatenate(b))
    if not a:
        none = np.empty(0, dtype=np.int64)
        return none, none
    return np.concatenate(a), np.concatenate(b)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    root = local_roots(n, a, b)
    at = np.flatnonzero(root != np.arange(n))
    return [root[at]], [at]


def _compare(radius: int, node: str):
    """Partitions of rows (bucket, fp, side, and `node` if another), sorted by bucket, to links between nodes."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fp, nodes = rows["fp"].to_numpy().view(np.uint64), rows[node].to_numpy()
        bucket = rows["bucket"].to_numpy()
        pop, side = np.bitwise_count(fp).astype(np.int64), rows["side"].to_numpy()
        group = np.cumsum(np.concatenate(([0], bucket[1:] != bucket[:-1])))
        order = np.lexsort((pop, group))
        fp, nodes, pop, group, side = fp[order], nodes[order], pop[order], group[order], side[order]
        (a,), (b,) = forest(len(fp), *tile_links(fp, pop, group, side, radius))
        return pd.DataFrame({"a": nodes[a], "b": nodes[b]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None or not len(held) else pd.concat([held, batch], ignore_index=True)
            if not len(held):
                continue
            last = held["bucket"].to_numpy() != held["bucket"].iloc[-1]
            whole = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last bucket may go on in the next batch
            if whole:
                yield links(held.iloc[:whole])
                held = held.iloc[whole:]
        if held is not None and len(held):
            yield links(held)

    return run


def linked(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE, node: str = "fp", blocks: int | None = None) -> DataFrame:
    """Links (a, b) that join every pair of distinct `fp` within `radius` bits, directly or by others.

    a and b are values of the column `node`, of which each fingerprint has one.
    """
    columns = list(dict.fromkeys(("fp", node)))
    masks = [F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(radius, blocks or blocks_for(fingerprints.count(), radius))]
    keyed = fingerprints.select(*columns, F.explode(F.array(*(F.xxhash64(F.lit(t), key) for t, key in enumerate(masks)))).alias("key"))
    sizes = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    rows = with_group(keyed, sizes, "key", "n")
    pop, parts = F.bit_count("fp").cast("long"), F.ceil(F.col("n") / F.lit(tile))
    one = F.array(F.struct(F.col("key").alias("bucket"), F.lit(0).alias("side")))
    # A tile of a large bucket: rows of one population count, dealt by a hash.  It meets each tile no more than `radius` counts away.
    own = F.pmod(F.xxhash64("fp"), parts)

    def pair(p, s):
        first = (p < pop) | ((p == pop) & (s < own))
        same = (p == pop) & (s == own)
        lo, lo_s = F.when(first, p).otherwise(pop), F.when(first, s).otherwise(own)
        hi, hi_s = F.when(first, pop).otherwise(p), F.when(first, own).otherwise(s)
        side = F.when(same, F.lit(0)).when(first, F.lit(2)).otherwise(F.lit(1))
        return F.struct(F.xxhash64("key", lo, lo_s, hi, hi_s).alias("bucket"), side.alias("side"))

    many = F.flatten(F.transform(F.sequence(pop - radius, pop + radius), lambda p: F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda s: pair(p, s))))
    rows = rows.select(*columns, F.explode(F.when(F.col("n") <= tile, one).otherwise(many)).alias("at")).select("at.bucket", *columns, "at.side")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_compare(radius, node), "a long, b long").distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Alternating large-star and small-star contraction until every node hangs on
    its root alone.  Minima of neighbours are summed before they shuffle, and
    nodes with many neighbours get theirs by broadcast, so that no task holds all
    links of one.  Each round is staged in the shared folder: a lost executor
    costs at most one round.
    """
    edges = staged(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u <> v").distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"), F.count_if(F.col("v") < F.col("u")).alias("up"))
        near = staged(near, name)
        if near.filter("up > 1 or (up = 1 and n > 1)").isEmpty():
            return near.select(F.col("u").alias("node"), F.col("m").alias("root"))
        large = with_group(both, near.select("u", "m", "n"), "u", "n").filter("v > u").select(F.col("m").alias("u"), "v")
        large = staged(large.filter("u <> v").distinct(), name)
        near = staged(large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")), name)
        joined = with_group(large, near, "v", "n")
        small = joined.select(F.explode(F.when(F.col("u") == F.col("m"), F.array("v")).otherwise(F.array("v", "u"))).alias("v"), F.col("m").alias("u"))
        edges = staged(small.select("u", "v").distinct(), name)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Every row's fingerprint and component: doc_id, fp (long), component_id.

    Texts are whole; A-Z are lower-cased, words lie between ASCII white space,
    fewer than `words` are one shingle.  Texts without a word, null ones too,
    have fingerprint 0 and are linked like any other.  component_id is the
    smallest doc_id reachable; repeated rows share it; a null id is passed over
    for the smallest, unless no other is there.  An empty table gives none.
    Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    of = fingerprint_column(words)
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fp")), "fingerprints")
    least = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct-fingerprints")
    roots = components(linked(least.select("fp"), radius, tile), "simhash-links")
    grouped = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    grouped = staged(grouped, "fingerprint-roots")
    smallest = staged(grouped.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("fps")), "fingerprint-components")
    of_fp = staged(with_group(grouped, smallest, "root", "fps").select("fp", "component_id", "n"), "fingerprint-groups")
    return with_group(rows, of_fp, "fp", "n").select("doc_id", "fp", "component_id")


def as_hex(fp) -> object:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
