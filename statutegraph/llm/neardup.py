"""Near-duplicate groups of a corpus, for a similarity rather than a few bits.

A SimHash within three bits means nearly equal texts; copies with a similarity of
0.8 differ in ten bits and more, and so do many texts that have nothing to do
with each other.  So links come from two searches.  The tiled comparison of
simhash.py links fingerprints within `radius` bits.  For the rest texts meet
where a band of MinHash values agrees: first each with the smallest id of its
band, then, in bands that this leaves in several components, the others with
each other.  Both are verified by the exact Jaccard similarity of their
shingles; only pairs whose numbers of distinct shingles rule it out are not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hashed_texts, mix64, powers, small_batches, staged, with_group, without_group
from .exact import hash_of, may_be_among
from .simhash import RADIUS, components, linked

WORDS = 5
SIMILARITY = 0.8
BANDS = 21
ROWS = 3
#: Members that one copy of a leader's shingles is compared with, and of a tile of a large band.
MEMBERS = 256
#: Shingles of a tile, about.
TILE_SHINGLES = 1 << 19

_A = powers(BANDS * ROWS + 1, 0xD1342543DE82EF95)[1:]
_B = mix64(_A)


def signature(h: np.ndarray) -> tuple[int, int, list[int]]:
    """SimHash, number of distinct hashes and band keys of a text's shingle hashes, repeats included; no shingle: 0, 0 and no band."""
    if not len(h):
        return 0, 0, []
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])
    least = np.array([((h ^ b) * a).min() for a, b in zip(_A, _B)], dtype=np.uint64).reshape(BANDS, ROWS)
    keys = mix64(least[:, 0] * _A[0] + least[:, 1] * _A[1] + least[:, 2] * _A[2] + np.arange(BANDS, dtype=np.uint64))
    return fp, len(np.unique(h)), keys.view(np.int64).tolist()


def _lowered(texts) -> Iterator[bytes]:
    return ((t or "").encode("utf-8", "replace").lower() for t in texts)


def signature_column(words: int):
    @F.pandas_udf("fp long, size long, bands array<long>")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([signature(h) for h in hashed_texts(_lowered(texts), words, punctuation=False)], columns=["fp", "size", "bands"])

    return of


def digest_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def shingles_column(words: int):
    """The sorted distinct shingle hashes of a text, as bytes."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(h).tobytes() for h in hashed_texts(_lowered(texts), words, punctuation=False)])

    return of


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _verify(similarity: float):
    """Rows (a, salt, id, shingles) sorted so that a's own row comes first, to the links that hold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, leader = None, None
        for batch in batches:
            out = []
            for a, salt, i, raw in zip(batch["a"], batch["salt"], batch["id"], batch["shingles"]):
                own = np.frombuffer(raw, dtype=np.uint64)
                if (a, salt) != at:
                    at, leader = (a, salt), own
                elif jaccard(leader, own) >= similarity:
                    out.append((a, i))
            yield pd.DataFrame(out, columns=["a", "b"])

    return run


def tile_forest(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join sets of that similarity whose roots differ: a spanning forest of them.

    side: 0 within one tile; sets of the same side, 1 or 2, have been compared elsewhere.
    """
    out, root = [], root.copy()
    lens = np.array([len(x) for x in sets], dtype=np.int64)
    every, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(lens) - lens
    has = np.zeros(len(every), dtype=bool)
    for i in range(len(sets) - 1):
        k = i + 1
        open_ = (root[k:] != root[i]) & ((side[k:] == 0) | (side[k:] != side[i]))
        if not open_.any():
            continue
        own = code[starts[i] : starts[k]]
        has[own] = True
        common = np.add.reduceat(has[code[starts[k] :]], starts[k:] - starts[k], dtype=np.int64)
        has[own] = False
        for j in k + np.flatnonzero(open_ & (common / (lens[i] + lens[k:] - common) >= similarity)):
            if root[j] != root[i]:
                out.append((i, int(j)))
                root[root == root[j]] = root[i]
    return out


def _compare_tiles(similarity: float):
    """Rows (bucket, side, id, root, shingles), sorted by bucket, to the links that hold."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["shingles"].map(len) > 0]
        out = []
        for _, b in rows.groupby("bucket", sort=False):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in b["shingles"]]
            ids = b["id"].tolist()
            out += [(ids[i], ids[j]) for i, j in tile_forest(sets, b["root"].to_numpy(), b["side"].to_numpy(), similarity)]
        return pd.DataFrame(out, columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = held["bucket"].to_numpy() != held["bucket"].iloc[-1] if len(held) else np.empty(0, dtype=bool)
            whole = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last bucket may go on in the next batch
            if whole:
                yield links(held.iloc[:whole])
                held = held.iloc[whole:]
        if held is not None and len(held):
            yield links(held)

    return run


def _sets(docs: DataFrame, texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the distinct `nodes`.  Only rows of `docs` that may hold their texts shuffle."""
    of = staged(texts.join(nodes, texts["node"] == nodes["id"], "left_semi").select(F.col("node"), F.col("id").alias("at"), "sha"), "near-needed")
    near = may_be_among(of.select(F.xxhash64("at").alias("h")))
    rows = docs.filter(near(F.xxhash64("id"))).withColumn("own", digest_of(F.col("text")))
    rows = rows.join(of, (rows["id"] == of["at"]) & (rows["own"] == of["sha"])).dropDuplicates(["node"])
    return rows.select(F.col("node").alias("id"), shingles_column(words)(F.col("text")).alias("shingles"))


def _tiles(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (bucket, side, id, root) of the members of bands that are still to be compared with each other.

    A band's leader has met every member; where the others have one root they
    are done.  Bands of the same members are dealt once.  Members that share the
    leader's root meet only the others, so that a large group that is linked
    already does not meet itself.
    """
    at = bands.join(roots, F.col("id") == F.col("node"), "left").select("band", "id", "size", "lead", F.coalesce("root", "id").alias("root"))
    led = staged(at.groupBy("band").agg(F.min_by("root", "id").alias("main"), F.count("*").alias("n")), "near-mains")
    at = staged(with_group(at.filter("id <> lead"), led, "band", "n").withColumn("other", F.col("root") != F.col("main")), "near-members")
    sums = [F.min("root").alias("lo"), F.max("root").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")]
    sums += [F.count_if("other" if k else ~F.col("other")).alias(f"n{k}") for k in (0, 1)]
    sums += [F.sum(F.when(F.col("other") == bool(k), F.col("size")).otherwise(0)).alias(f"size{k}") for k in (0, 1)]
    left = at.groupBy("band", "main").agg(*sums).filter("lo < hi")
    left = left.groupBy("main", "x", "y", "n0", "n1", "size0", "size1").agg(F.min("band").alias("band")).drop("main")
    parts = [F.greatest(F.ceil(F.col(f"n{k}") / F.lit(MEMBERS)), F.ceil(F.col(f"size{k}") / F.lit(TILE_SHINGLES))).cast("long").alias(f"parts{k}") for k in (0, 1)]
    small = ((F.col("n0") + F.col("n1") <= MEMBERS) & (F.col("size0") + F.col("size1") <= TILE_SHINGLES)).alias("small")
    left = staged(left.select("band", (F.col("n0") + F.col("n1")).alias("of"), small, *parts), "near-open")
    at = with_group(at.select("band", "id", "root", "other"), left, "band", "of")
    p0, p1 = F.col("parts0"), F.col("parts1")
    own = F.when(F.col("other"), p0 + F.pmod(F.xxhash64("id"), F.greatest(p1, F.lit(1)))).otherwise(F.pmod(F.xxhash64("id"), F.greatest(p0, F.lit(1))))
    whole = F.array(F.struct(F.xxhash64("band").alias("bucket"), F.lit(0).alias("side")))

    def pair(s):
        side = F.when(s == F.col("own"), F.lit(0)).when(F.col("own") < s, F.lit(1)).otherwise(F.lit(2))
        return F.struct(F.xxhash64("band", F.least(s, F.col("own")), F.greatest(s, F.col("own"))).alias("bucket"), side.alias("side"))

    meets = F.filter(F.sequence(F.when(F.col("other"), F.lit(0)).otherwise(p0).cast("long"), p0 + p1), lambda s: s < p0 + p1)
    at = at.withColumn("own", own).select("id", "root", F.explode(F.when(F.col("small"), whole).otherwise(F.transform(meets, pair))).alias("to"))
    return at.select("to.bucket", "to.side", "id", "root")


def verified_links(docs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (a, b) between nodes of `texts` (node, id, sha, size, bands) of that similarity, `docs` having (id, text).

    In each band the smallest node leads and members are compared with it, which
    settles most bands.  In those whose members are not of one component then, the
    members are compared with each other, large bands as pairs of tiles.
    """
    keyed = texts.select(F.col("node").alias("id"), "size", F.explode("bands").alias("band"))
    leads = staged(keyed.groupBy("band").agg(F.min(F.struct("id", "size")).alias("lead"), F.count("*").alias("n")).filter("n > 1"), "near-leads")
    bands = with_group(keyed, leads, "band", "n").select("band", "id", "size", "n", F.col("lead.id").alias("lead"), F.col("lead.size").alias("lead_size"))
    bands = staged(bands, "near-bands")
    # Sets of that similarity hold at least that share of each other's number; a little less for rounding.
    may = F.least("size", "lead_size") >= F.greatest("size", "lead_size") * F.lit(similarity - 1e-9)
    pairs = staged(bands.filter((F.col("id") != F.col("lead")) & may).select(F.col("lead").alias("a"), "id").distinct(), "near-pairs")
    salts = staged(pairs.groupBy("a").agg(F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / F.lit(MEMBERS))), "near-salts")
    members = with_group(pairs, salts, "a", "n").select("a", F.pmod(F.xxhash64("id"), "salts").alias("salt"), "id", F.lit(1).alias("turn"))
    leaders = salts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("a").alias("id"), F.lit(0).alias("turn"))
    asked = pairs.select("id").unionByName(pairs.select(F.col("a").alias("id"))).distinct()
    rows = members.unionByName(leaders).join(_sets(docs, texts, asked, words), "id").select("a", "salt", "turn", "id", "shingles")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "turn", "id")
    led = staged(rows.drop("turn").mapInPandas(_verify(similarity), "a long, b long"), "near-led")
    tiles = staged(_tiles(bands.filter("n > 2"), components(led, "near-led-links")), "near-tiles")
    if tiles.isEmpty():
        return led
    rows = tiles.join(_sets(docs, texts, tiles.select("id").distinct(), words), "id").select("bucket", "side", "id", "root", "shingles")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return led.unionByName(staged(rows.mapInPandas(_compare_tiles(similarity), "a long, b long"), "near-tiled"))


def distinct_texts(signed: DataFrame) -> DataFrame:
    """A row for each distinct text of `signed`: sha, id (its smallest), copies, fp, size, bands and a number of its own as `node`.

    The node is the id; of several texts under one id all but one get a hash of
    id and digest instead.
    """
    texts = signed.groupBy("sha").agg(F.min("id").alias("id"), F.count("*").alias("copies"), *(F.any_value(c).alias(c) for c in ("fp", "size", "bands")))
    texts = staged(texts, "near-texts")
    shared = staged(texts.groupBy("id").agg(F.count("*").alias("n"), F.min("sha").alias("least")).filter("n > 1"), "near-shared-ids")
    if shared.isEmpty():
        return texts.withColumn("node", F.col("id"))
    other = with_group(texts, shared, "id", "n", how="left")
    node = F.when(F.col("sha") != F.col("least"), F.xxhash64("id", "sha")).otherwise(F.col("id"))
    return staged(other.select(*texts.columns, node.alias("node")), "near-nodes")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each distinct text: sha, doc_id (the smallest that has it), copies, repeats, component_id, keep_sha.

    component_id is the smallest id of the group.  The text with the digest
    `keep_sha` stays: that of the smallest id, and of several texts under that id
    the one of the smallest digest.  `repeats` is how many rows have both this
    doc_id and this text.  Null texts count as empty; all texts without a word
    are one group; very long texts are hashed whole.  Rows with a null id take no
    part; an empty table gives none.  Ids are integers.  Other columns are not
    looked at.

    Equal texts are one from the start, so that only distinct ones are searched
    and linked, however many rows hold them.
    """
    small_batches(docs.sparkSession)
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = rows.select("id", digest_of(F.col("text")).alias("sha"), signature_column(words)(F.col("text")).alias("s"))
    signed = staged(signed.select("id", "sha", "s.fp", "s.size", "s.bands"), "near-signatures")
    texts = distinct_texts(signed)
    of_fp = staged(texts.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), "near-fingerprints")
    same = with_group(texts.select("node", "fp"), of_fp, "fp", "n").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = same.unionByName(linked(of_fp.select("fp", "first"), radius, node="first")).unionByName(verified_links(rows, texts, words, similarity))
    roots = components(links, "near-links")
    found = texts.select("sha", "id", "copies", F.col("node").alias("own")).join(roots, F.col("own") == F.col("node"), "left")
    found = staged(found.select("sha", "id", "copies", F.coalesce("root", "own").alias("root")), "near-roots")
    kept = found.groupBy("root").agg(F.min(F.struct("id", "sha")).alias("keep"), F.count("*").alias("n"))
    out = with_group(found, staged(kept, "near-kept"), "root", "n").select("sha", "id", "copies", F.col("keep.id").alias("component_id"), F.col("keep.sha").alias("keep_sha"))
    repeated = signed.groupBy("id", "sha").agg(F.count("*").alias("repeats")).filter("repeats > 1")
    out = out.join(repeated, ["id", "sha"], "left")
    return out.select("sha", F.col("id").alias("doc_id"), "copies", F.coalesce("repeats", F.lit(1)).alias("repeats"), "component_id", "keep_sha")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each group one, that with the smallest id.

    Of several texts under that id the one of the smallest digest stays, of rows
    that repeat id and text any one.  Null and empty texts and all without a word
    are copies of each other.  Rows with a null id take no part and stay.  An
    empty table gives none; columns may have any name.  Only rows whose text may
    be in a group of several shuffle, found by a Bloom filter of the digests; the
    rest pass straight through.
    """
    groups = near_groups(docs, id_col, text_col, words, radius, similarity).filter("copies > 1 or sha <> keep_sha")
    sha, size, repeats, keep = fresh(docs, "sha", "copies", "repeats", "keep")
    keeps = F.when(F.col("sha") == F.col("keep_sha"), F.col("component_id"))
    groups = staged(groups.select(F.col("sha").alias(sha), F.col("copies").alias(size), F.col("repeats").alias(repeats), keeps.alias(keep)), "near-groups")
    maybe = may_be_among(groups.select(hash_of(sha).alias("h")))(hash_of(sha))
    rows = docs.withColumn(sha, digest_of(F.col(text_col)))
    has_id = F.col(id_col).isNotNull()
    rest = rows.filter(~has_id).unionByName(rows.filter(has_id).filter(~maybe)).select(docs.columns)
    met = with_group(rows.filter(has_id).filter(maybe), groups, sha, size, how="left")
    met = met.filter(F.col(size).isNull() | (F.col(id_col).cast("long") == F.col(keep)))
    if groups.filter((F.col(repeats) > 1) & F.col(keep).isNotNull()).isEmpty():
        return rest.unionByName(met.select(docs.columns))
    one = met.filter(F.col(repeats) > 1).dropDuplicates([id_col, sha])
    return rest.unionByName(met.filter(F.coalesce(repeats, F.lit(1)) == 1).select(docs.columns)).unionByName(one.select(docs.columns))
