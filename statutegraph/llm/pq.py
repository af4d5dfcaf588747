"""Vectors as short codes: each part of a vector is replaced by the number of its nearest codebook entry.

The codebooks are fitted by rounds of Lloyd's method with two trees, one over a
batch's vector parts and one over the codebook's entries.  The trees are walked
together level by level: the distances between the boxes of two nodes bound those
of all their points, so most combinations are never looked at, a node with only
one entry left is assigned whole by its stored sum, and what stays uncertain in
the leaves is decided by exact integer distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, spans, staged, with_group

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Components are integers of this many steps to 1.
STEPS = 256
#: Larger integers count as this one, so that squared distances of 256 dimensions fit 64 bits.
LIMIT = 1 << 26
#: Vectors whose parts share a tree.
BATCH = 8192
#: Parts in a leaf, at most.
LEAF = 16
#: Distances that are taken at once.
SLAB = 1 << 18


@dataclass(frozen=True)
class Codebooks:
    """`entries`: part, entry, position in the part; integers."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Tree:
    """Balanced trees over `len(points) / n` runs of `n` points each, all of one shape.

    A level holds its nodes in order: `starts` and `sizes` of their points in
    `order`, their boxes `lo` and `hi`, their `sums`.  Node i of a level has the
    children 2i and 2i + 1 of the next.
    """

    def __init__(self, points: np.ndarray, n: int, leaf: int):
        starts, sizes = np.arange(0, len(points), n), np.full(len(points) // n, n)
        self.order, shape = np.arange(len(points)), [(starts, sizes)]
        while sizes.max() > leaf and sizes.min() > 1:
            at = points[self.order]
            wide = (np.maximum.reduceat(at, starts) - np.minimum.reduceat(at, starts)).argmax(axis=1)
            node = np.repeat(np.arange(len(starts)), sizes)
            self.order = self.order[np.lexsort((at[np.arange(len(at)), wide[node]], node))]
            half = sizes // 2
            starts, sizes = np.stack([starts, starts + half], 1).ravel(), np.stack([half, sizes - half], 1).ravel()
            shape.append((starts, sizes))
        self.points = points[self.order]
        self.levels = [(s, c, np.minimum.reduceat(self.points, s), np.maximum.reduceat(self.points, s), np.add.reduceat(self.points, s)) for s, c in shape]


def _pruned(of: tuple, to: tuple, p: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of nodes, ordered by `p`, that may hold a nearest entry of some point.

    Some entry is no farther from any point of the node than the least of the
    largest distances; a pair that lies beyond that even at its closest is no one's.
    """
    gap = np.maximum(0, np.maximum(of[2][p] - to[3][e], to[2][e] - of[3][p]))
    far = np.maximum(of[3][p] - to[2][e], to[3][e] - of[2][p])
    new = np.concatenate(([True], p[1:] != p[:-1]))
    bound = np.minimum.reduceat((far * far).sum(axis=1), np.flatnonzero(new))
    keep = (gap * gap).sum(axis=1) <= bound[np.cumsum(new) - 1]
    return p[keep], e[keep]


def assigned(parts: Tree, book: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each point the nearest entry of its run's codebook, ties to the lower one; the sums and numbers of each entry's points.

    Entries are numbered through over all codebooks.
    """
    n, k, dims = len(parts.order), len(book.order), parts.points.shape[1]
    nearest, sums, counts = np.empty(n, np.int64), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    p = e = np.arange(len(parts.levels[0][0]))
    level = 0
    while len(p):
        of, to = parts.levels[min(level, len(parts.levels) - 1)], book.levels[min(level, len(book.levels) - 1)]
        p, e = _pruned(of, to, p, e)
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        alone = np.repeat(np.diff(np.append(first, len(p))) == 1, np.diff(np.append(first, len(p)))) & (to[1][e] == 1)
        whole, entry = p[alone], book.order[to[0][e[alone]]]
        nearest[parts.order[spans(of[0][whole], of[1][whole])]] = np.repeat(entry, of[1][whole])
        np.add.at(sums, entry, of[4][whole])
        np.add.at(counts, entry, of[1][whole])
        p, e = p[~alone], e[~alone]
        level += 1
        deeper_p, deeper_e = level < len(parts.levels), level < len(book.levels)
        if not deeper_p and not deeper_e:
            break
        if deeper_e:
            p, e = np.repeat(p, 2), np.stack([2 * e, 2 * e + 1], 1).ravel()
        if deeper_p:
            p, e = np.concatenate([2 * p, 2 * p + 1]), np.concatenate([e, e])
            by = np.argsort(p, kind="stable")
            p, e = p[by], e[by]
    if len(p):
        _by_distance(parts, book, p, e, nearest, sums, counts)
    return nearest, sums, counts


def _by_distance(parts: Tree, book: Tree, p: np.ndarray, e: np.ndarray, nearest: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Decide the points of leaves `p` between the entries of leaves `e`."""
    of, to = parts.levels[-1], book.levels[-1]
    first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    leaf = p[first]
    at = spans(to[0][e], to[1][e])
    choices = np.add.reduceat(to[1][e], first)
    from_ = np.cumsum(choices) - choices
    slab = np.cumsum(choices * of[1][leaf]) // SLAB
    for cut in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(slab)) + 1):
        points = spans(of[0][leaf[cut]], of[1][leaf[cut]])
        many = np.repeat(choices[cut], of[1][leaf[cut]])
        picked = at[spans(np.repeat(from_[cut], of[1][leaf[cut]]), many)]
        gap = np.repeat(parts.points[points], many, axis=0) - book.points[picked]
        distance, start = (gap * gap).sum(axis=1), np.cumsum(many) - many
        least = np.repeat(np.minimum.reduceat(distance, start), many)
        entry = np.minimum.reduceat(np.where(distance == least, book.order[picked], len(book.order)), start)
        nearest[parts.order[points]] = entry
        np.add.at(sums, entry, parts.points[points])
        np.add.at(counts, entry, 1)


# ---------------------------------------------------------------- over tables


def _good(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf)), F.lit(False))


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * STEPS))).cast("int"))


def prepared(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """id, label and integer vector of the rows that have a vector of finite components."""
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    vector = F.col(vector_col)
    return rows.filter(_good(vector)).select(F.col(id_col).alias("id"), label.alias("label"), _integers(vector).alias("v"))


def _points(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """A batch's vectors, cut: part, vector, position in the part."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.ascontiguousarray(flat.reshape(batch.num_rows, parts, -1).transpose(1, 0, 2))


def _assigned_batches(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    parts, k, dims = books.entries.shape
    book = Tree(books.entries.reshape(-1, dims), k, 1)
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            points = _points(batch, parts)
            yield batch, points, *assigned(Tree(points.reshape(-1, dims), batch.num_rows, LEAF), book)


def _totals(books: Codebooks):
    """Tasks that give the sums (slot: entry and position) and numbers (slot: after those) of each entry's parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, _, _, sums, counts in _assigned_batches(batches, books):
            row = np.concatenate([sums.ravel(), counts])
            total = row if total is None else total + row
        if total is not None:
            slot = np.flatnonzero(total)
            yield pa.record_batch([pa.array(slot), pa.array(total[slot])], ["slot", "amount"])

    return run


def one_shape(rows: DataFrame, parts: int) -> tuple[DataFrame, list]:
    """The prepared rows that can be cut like the first one that can, and its length (none: 0) with the rows that start the codebooks.

    Vectors of another length, or of one that is no multiple of `parts`, cannot be
    coded with the others.
    """
    rows = rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v").alias("n")).first()
    length = first["n"] if first else 0
    return rows.filter(F.size("v") == length), length


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of prepared rows of one length.

    They start as the parts of the vectors with the smallest ids (ties by the
    vector, null ids last), one entry for each, fewer if there are fewer vectors.
    A round gives every part to its nearest entry and moves each entry to the
    floor of its parts' mean; an entry without parts stays.  The driver gets
    the codebooks' own size, whatever the number of rows.
    """
    start = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not start:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    books = Codebooks(np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        shape = books.entries.shape
        cells = shape[0] * shape[1]
        found = rows.select("v").mapInArrow(_totals(books), "slot long, amount long")
        got = {r["slot"]: int(r["amount"]) for r in found.groupBy("slot").agg(F.sum(F.col("amount").cast("decimal(20,0)")).alias("amount")).collect()}
        flat = books.entries.reshape(cells, -1).copy()
        for cell in range(cells):
            if count := got.get(cells * shape[2] + cell, 0):
                flat[cell] = [got.get(cell * shape[2] + d, 0) // count for d in range(shape[2])]
        books = Codebooks(flat.reshape(shape))
    return books


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """id, label, code, error of prepared rows: the entry numbers in part order, two hex digits each, and the squared distances summed over the parts."""
    parts, k, _ = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, points, nearest, _, _ in _assigned_batches(batches, books):
            gap = points.reshape(len(nearest), -1) - books.entries.reshape(parts * k, -1)[nearest]
            error = (gap * gap).sum(axis=1).reshape(parts, -1).sum(axis=0)
            code = (nearest.reshape(parts, -1) - np.arange(parts)[:, None] * k).astype(np.uint8).T
            text = np.ascontiguousarray(code).tobytes().hex()
            codes = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array(codes), pa.array(error)], ["id", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def coded_vectors(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of `embeddings`, coded by codebooks fitted on all of them.

    Rows whose vector is null, empty, or holds null or non-finite components are
    left out, and so are those whose length is no multiple of `parts` or another
    than that of the smallest vec_id which has such a one.  Components of 2^18 and
    more count as that.  Null ids come after all others; repeated rows count each.
    `label_error` sums the errors of equal labels, null ones together.  Nothing
    in, nothing out; other columns are not looked at.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits holds 256 entries")
    vectors, length = one_shape(prepared(rows), parts)
    if not length:
        books = Codebooks(np.zeros((parts, 0, 0), np.int64))
        coded = vectors.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    else:
        books = fit(vectors, parts, entries, rounds)
        coded = encoded(vectors, books)
    coded = staged(coded.select("id", row_key(F.col("label")).alias("_label"), "code", "error"), "codes")
    groups = staged(coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "label-errors")
    return with_group(coded, groups, "_label", "_n").select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))
