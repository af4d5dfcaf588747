"""The trie of conversations: every distinct beginning is a node, with what hangs on it.

Turns are encoded by a dictionary, so a conversation is an array of numbers.
Distinct arrays are sorted into range shards; each shard builds a ternary search
tree of its arrays, inserting medians first, and sums over it without recursion.
Only nodes on the paths that a shard shares with its neighbours need the others:
they are known by the shard in which they begin and their depth, and merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import placed_in_order, ranked, staged, with_group

#: Conversations of one block begin like its first one.
BLOCK = 100
#: A conversation takes fewer turns than this of the block's first one.
SHARED = 6

_NONE = hashlib.sha256(b"").hexdigest()


def encoded(rows: DataFrame) -> DataFrame:
    """conv_id, ids, chars: each conversation's turns as numbers, and their lengths in code points.

    Equal (role, text) have equal numbers, ascending with role and text.  Turns
    that very many conversations share meet their number by broadcast.
    """
    rows = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    words, _ = ranked(rows.groupBy("role", "text").agg(F.count("*").alias("_n")), [F.col("role"), F.col("text")], "turn-dictionary")
    words = staged(words.select(key.alias("_key"), F.col("_rank").alias("id"), F.length("text").cast("long").alias("chars"), "_n"), "turn-ids")
    found = with_group(rows.select("conv_id", "turn", key.alias("_key")), words, "_key", "_n")
    turns = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("t"))
    return staged(turns.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars")), "encoded-conversations")


def rebuilt(convs: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """Conversations that begin like the first one of their block of ids, as far as a checksum of their own id says."""
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")
    of_block = convs.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_base"), *(F.slice(c, 1, shared - 1).alias(f"_{c}") for c in ("ids", "chars")))
    rows = convs.withColumns({"_h": h, "_base": F.col("conv_id") - F.col("conv_id") % block}).join(of_block, "_base", "left")

    def joined(c: str) -> Column:
        return F.concat(F.slice(F.coalesce(f"_{c}", F.array().cast("array<bigint>")), F.lit(1), F.col("_h")), F.slice(c, F.col("_h") + 1, F.size(c))).alias(c)

    return staged(rows.select("conv_id", joined("ids"), joined("chars")), "rebuilt-conversations")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's pieces, which come in order, joined by commas; nothing is held but the digest so far."""
    at, digest = None, None
    for batch in batches:
        keys, out = [], []
        for key, piece in zip(batch.column("_key").to_pylist(), batch.column("piece").to_pylist()):
            if key == at:
                digest.update(b",")
            else:
                if at is not None:
                    keys.append(at)
                    out.append(digest.hexdigest())
                at, digest = key, hashlib.sha256()
            digest.update(piece.encode())
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["_key", "ends"])
    if at is not None:
        yield pa.record_batch([pa.array([at]), pa.array([digest.hexdigest()])], ["_key", "ends"])


def ends_of(rows: DataFrame) -> DataFrame:
    """_key, ends: the SHA-256 of the conv_ids of each `_key`, in order and joined by commas.

    Ids are sorted and joined in range partitions, however many share a key; a
    key's digest then takes up its pieces one after another.
    """
    rows = placed_in_order(rows, [F.col("_key"), F.col("conv_id")], "ends")
    pieces = rows.groupBy("_key", "_part").agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("piece"))
    return pieces.repartition("_key").sortWithinPartitions("_key", "_part").select("_key", "piece").mapInArrow(_digests, "_key string, ends string")


# ---------------------------------------------------------------- one shard


class TernaryTree:
    """A trie whose siblings are binary search trees; node 0 is the root, parents come before their children."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.down = [0], [-1], [-1], [-1]
        self.up, self.depth = [-1], [0]

    def _new(self, turn: int, up: int) -> int:
        for column, value in ((self.turn, turn), (self.low, -1), (self.high, -1), (self.down, -1), (self.up, up), (self.depth, self.depth[up] + 1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int]) -> list[int]:
        """The nodes of the path, the root first."""
        path, node = [0], 0
        for turn in turns:
            links, at = self.down, node
            while (to := links[at]) >= 0 and self.turn[to] != turn:
                links, at = (self.low if turn < self.turn[to] else self.high), to
            if to < 0:
                to = self._new(turn, node)
                links[at] = to
            path.append(to)
            node = to
        return path

    def walk(self) -> list[int]:
        """All nodes, each before those below it."""
        order, stack = [0], [self.down[0]]
        while stack:
            if (node := stack.pop()) >= 0:
                order.append(node)
                stack += (self.low[node], self.high[node], self.down[node])
        return order


def medians_first(n: int) -> Iterator[int]:
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            yield (mid := (a + b) // 2)
            stack += ((mid + 1, b), (a, mid))


_FIELDS = "part int, depth int, conv_id long, parent_conv_id long, parent_part int, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
_ARROW = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.split()[1]]) for f in _FIELDS.split(", ")])


def _shard(edges: dict[int, tuple[int, int, int]]):
    """The nodes of one shard.

    `edges`: for each shard that has rows the turns that its first array shares
    with the array before it (-1 if there is none), its last with the one after
    it, and its first with its last.  A node that is shared with another shard
    has the number of the shard in which it begins as `part`, and counts here
    only what this shard adds; others have none and are whole.
    """
    parts = sorted(edges)

    def begins(at: int, depth: int) -> int:
        """The shard before parts[at] in which the node at `depth` of parts[at]'s first path begins."""
        at -= 1
        while min(edges[parts[at]][0], edges[parts[at]][2]) >= depth:
            at -= 1
        return parts[at]

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")
        part = rows.column("_part")[0].as_py()
        before, after, _ = edges[part]
        at = parts.index(part)
        ids, chars, convs, least, ends = (rows.column(c).to_pylist() for c in ("ids", "chars", "n", "conv_id", "ends"))
        tree, members, first, length, own_ends, border = TernaryTree(), [0], [None], [0], [None], {}
        for i in medians_first(len(ids)):
            path = tree.insert(ids[i])
            for depth, node in enumerate(path):
                if node == len(members):
                    members.append(0)
                    first.append(None)
                    length.append(chars[i][depth - 1])
                    own_ends.append(None)
                members[node] += convs[i]
                first[node] = least[i] if first[node] is None else min(first[node], least[i])
            own_ends[path[-1]] = ends[i]
            if i == len(ids) - 1:
                border |= {node: part for depth, node in enumerate(path) if depth <= after}
                goes_on = path[-1] if len(path) - 1 <= after else -1
            if i == 0:
                first_path = path
        begun = {node for depth, node in enumerate(first_path) if depth <= before}  # in a shard before this one
        border |= {node: begins(at, tree.depth[node]) for node in begun}
        children, leaves, saved = ([0] * len(members) for _ in range(3))
        order = tree.walk()
        for node in reversed(order):
            saved[node] += (members[node] - (node not in begun)) * length[node]
            if tree.down[node] < 0 and node != goes_on:
                leaves[node] += 1
            if node:
                up = tree.up[node]
                children[up] += node not in begun
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        up = [tree.up[v] for v in order]
        columns = [
            [border.get(v) for v in order],
            [tree.depth[v] for v in order],
            [first[v] for v in order],
            [first[u] if u >= 0 and u not in border else None for u in up],
            [border.get(u) for u in up],
            *([c[v] for v in order] for c in (members, children, leaves, saved, own_ends)),
        ]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return run


# ---------------------------------------------------------------- all shards


def _common(a: Column, b: Column) -> Column:
    """How many leading elements two arrays share."""
    miss = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(miss > 0, miss - 1).otherwise(F.size(a)).cast("int")


def _edges(shards: DataFrame) -> dict[int, tuple[int, int, int]]:
    """What each shard shares with its neighbours: a row of three numbers for each range partition."""
    ends = shards.groupBy("_part").agg(F.min("ids").alias("a"), F.max("ids").alias("z"))
    order = W.orderBy("_part")
    found = ends.select(
        "_part",
        F.when(F.lag("z").over(order).isNull(), -1).otherwise(_common(F.lag("z").over(order), F.col("a"))).alias("before"),
        F.when(F.lead("a").over(order).isNull(), -1).otherwise(_common(F.col("z"), F.lead("a").over(order))).alias("after"),
        _common(F.col("a"), F.col("z")).alias("inner"),
    )
    return {r["_part"]: (r["before"], r["after"], r["inner"]) for r in found.collect()}


def nodes(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of `convs` (conv_id, ids, chars), the root among them.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    convs = convs.withColumn("_key", F.sha2(F.array_join("ids", ","), 256))
    groups = convs.groupBy("_key", "ids", "chars").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    groups = groups.join(ends_of(convs.select("_key", "conv_id")), "_key").drop("_key")
    shards = placed_in_order(groups, [F.col("ids")], "trie-shards").withColumn("_part", F.col("_part").cast("int"))
    found = staged(shards.groupBy("_part").applyInArrow(_shard(_edges(shards)), _FIELDS), "trie-nodes")
    shared = found.filter(F.col("part").isNotNull()).groupBy("part", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.max("parent_part").alias("parent_part"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends").alias("ends"),
    )
    shared = staged(shared, "trie-shared-nodes")
    every = found.filter(F.col("part").isNull()).unionByName(shared).drop("part").withColumn("_up", F.struct(F.col("parent_part").alias("part"), (F.col("depth") - 1).alias("depth")))
    parents = shared.filter("n_children > 0").select(F.struct("part", "depth").alias("_up"), F.col("conv_id").alias("_parent"), "n_children")
    rest = every.filter(F.col("parent_part").isNull())
    below = with_group(every.filter(F.col("parent_part").isNotNull()), parents.withColumnRenamed("n_children", "_n"), "_up", "_n").withColumn("parent_conv_id", F.col("_parent"))
    out = rest.unionByName(below.select(*rest.columns))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(_NONE)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of `conversations` (conv_id, turn, role, text), rebuilt by block, one row for each node.

    Turns go by number, null ones first, ties by role and text; null roles and
    texts are empty.  Rows without a conv_id belong to no conversation and are left
    out.  Repeated rows are turns of their own.  A conversation is one row of
    numbers, however long its texts are.  No conversation gives no node; other
    columns are not looked at.
    """
    return nodes(rebuilt(encoded(conversations.select("conv_id", "turn", "role", "text"))))
