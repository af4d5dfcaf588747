import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from frames import with_clashes
from statutegraph.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """By tuples of turns."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        made[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    children = Counter(n[:-1] for n in members if n)
    out = Counter()
    for node, cs in members.items():
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below[node] if n)
        leaves = sum(not children[n] for n in below[node])
        ends = ",".join(str(c) for c in sorted(cs) if made[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out[min(cs), len(node), parent, len(cs), children[node], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def check(spark, rows, clashing=False, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = trie.conversation_trie(with_clashes(df.drop("id")) if clashing else df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def some(n, seed, turns=4, words=3, longest=7):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"][: 1 + t % 2]), "x" * rng.randrange(words)) for c in range(n) for t in range(rng.randrange(longest))]


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_rows(spark, clashing):
    rows = [(0, 1, "user", "hallo"), (0, 0, None, None), (0, None, "system", "é漢😀"), (0, None, "system", "é漢😀"), (0, 1, "user", "du"), (0, 1, "assistant", "zz")]
    rows += [(1, 0, "user", "allein"), (250, 0, "user", "a"), (250, 1, "user", "b"), (-3, 0, "user", "minus"), (-103, 0, "user", "minus"), (-100, 5, "user", "base"), (None, 0, "user", "niemand")]
    rows += [(7, 0, "ab", "c"), (8, 0, "a", "bc"), (9, 0, "user", "lang " * 50_000), (1200, 0, "user", "lang " * 50_000)]
    check(spark, rows + [(c, t, "user", "same") for c in range(20, 60) for t in range(8)], clashing)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    check(spark, some(400, seed))


def test_shards_share_deep_paths(spark):
    """Few distinct turns, long conversations: paths run through several shards, some of a single row."""
    rows = [(c * 100, t, "user", "ab"[(c >> t) & 1] if t < 6 else "tail") for c in range(60) for t in range(6 + c % 3)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        check(spark, rows)
        check(spark, [(c * 100, t, "user", "same" if t < 40 else f"{c % 9}") for c in range(50) for t in range(40 + c % 5)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_nothing(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    """Base absent, and all its own turns among those replaced."""
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    check(spark, [(c, 0, "user", "x")])


def test_medians_first_balances():
    assert sorted(trie.medians_first(100)) == list(range(100))
    tree = trie.TernaryTree()
    for i in trie.medians_first(1023):
        tree.insert([i])
    height, stack = 0, [(tree.down[0], 1)]
    while stack:
        node, at = stack.pop()
        if node >= 0:
            height = max(height, at)
            stack += [(tree.low[node], at + 1), (tree.high[node], at + 1)]
    assert height == 10


def test_ids_of_one_node_are_digested_in_pieces(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("_key"), (F.col("id") * 7919 % 5000).alias("conv_id"))
    got = {r["_key"]: r["ends"] for r in trie.ends_of(rows).collect()}
    want = defaultdict(list)
    for i in range(5000):
        want["hot" if i % 3 == 0 else str(i)].append(i * 7919 % 5000)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
