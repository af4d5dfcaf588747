import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from frames import AWKWARD, documents
from statutegraph.llm import common, exact, mixing, sharding

# ---------------------------------------------------------------- exact duplicates


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        g = groups[r[1] or ""]
        keep = max((i for i in g if i is not None), default=None)
        out.append((r[0], keep, len(g), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_equals_brute_force(spark, clashing):
    rows = AWKWARD + [(100 + i, f"text {i % 7}") for i in range(50)]
    got = exact.exact_groups(documents(spark, rows, clashing))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_exact(rows)


def test_exact_of_nothing(spark):
    assert exact.exact_groups(documents(spark, [])).count() == 0


def test_exact_with_a_full_filter_gives_the_same(spark):
    rows = [(i, f"text {i // 2 if i < 20 else i}") for i in range(3000)]
    got = exact.exact_groups(documents(spark, rows), max_filter_bytes=64)
    assert Counter(map(tuple, got.collect())) == brute_exact(rows)


def test_maps_never_miss_a_repeat_and_rarely_mark_a_single(spark):
    rng = np.random.default_rng(1)
    single, twice = rng.integers(0, 1 << 60, 20_000), rng.integers(0, 1 << 60, 500)
    hashes = spark.createDataFrame([(int(h),) for h in [*single, *twice, *twice]], "h long").repartition(7)
    for max_bytes in (exact.MAX_FILTER_BYTES, 1 << 14):  # one turn, four turns
        got = exact.marked(hashes, F.col("h"), "test", max_bytes).collect()
        assert Counter(r.h for r in got) == Counter([*single.tolist(), *twice.tolist(), *twice.tolist()])
        marks = {r.h for r in got if r.again}
        assert marks >= set(twice.tolist()) and len(marks - set(twice.tolist())) < 0.01 * len(single)


def test_a_filter_of_ids_misses_none_however_small(spark):
    ids = spark.range(0, 2000).withColumn("h", F.xxhash64("id"))
    others = spark.range(10_000, 30_000).withColumn("h", F.xxhash64("id"))
    for max_bytes, alarms in ((exact.MAX_FILTER_BYTES, 0.01), (64, 1)):
        among = exact.may_be_among(ids.select("h"), max_bytes)
        assert ids.filter(among(F.col("h"))).count() == 2000
        assert others.filter(among(F.col("h"))).count() <= alarms * 20_000
    assert others.filter(exact.may_be_among(ids.select("h").limit(0))(F.col("h"))).isEmpty()


def test_singles_pass_straight_beyond_one_filter_and_little_is_sent(spark):
    """Four million rows, maps of 8 MB of which 1 MB is broadcast at a time."""
    n = 1 << 22
    rows = spark.range(0, n, numPartitions=8).withColumn("key", F.when(F.col("id") % 1000 == 0, F.lit(-1)).otherwise(F.col("id")))
    ranges, each = exact.filter_shape(n)
    assert ranges + each == 26
    x = rows.select(F.xxhash64("key").alias("x"))
    sent = x.mapInPandas(exact._send(ranges), "range long, hashes binary").agg(F.sum(F.octet_length("hashes") + 8).alias("bytes")).first()["bytes"]
    assert sent <= 2 * 8 * n
    got = exact.marked(rows, F.col("key"), "test", 1 << 20)
    counts = {(r["hot"], r["again"]): r["n"] for r in got.groupBy((F.col("key") == -1).alias("hot"), "again").agg(F.count("*").alias("n")).collect()}
    hot = -(-n // 1000)
    assert counts.get((True, True)) == hot and (True, False) not in counts
    assert counts[False, False] >= 0.99 * (n - hot) and counts[False, False] + counts.get((False, True), 0) == n - hot


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (3, 3)])
def test_hilbert_curve_is_a_walk_of_single_steps(spark, dims, bits):
    cells = [tuple((n >> bits * d) & ((1 << bits) - 1) for d in range(dims)) for n in range(1 << bits * dims)]
    names = [f"c{d}" for d in range(dims)]
    df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    at = {r["_curve"]: tuple(r[n] for n in names) for r in sharding.with_hilbert_index(df, names, bits).collect()}
    assert sorted(at) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(len(cells) - 1))


def curve_of(cell, bits):
    """The index of a cell by numbers: inverse turns of each level, Gray code, then bits interleaved."""
    x, n = list(cell), len(cell)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        if x[-1] & q:
            t ^= q - 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_curve_of_documents_equals_numbers(spark):
    """More values than codes in one dimension, nulls in two, sizes over many magnitudes."""
    rows = [(i, "x" * (i * i), ("en", "de", None)[i % 3], f"s{i % 90:02d}" if i % 7 else None) for i in range(300)]
    order = lambda at: {v: i for i, v in enumerate(sorted({r[at] for r in rows}, key=lambda v: (v is None, v or "")))}
    sources, langs = order(3), order(2)
    magnitude = lambda n: min(63, 2 * ((n + 1).bit_length() - 1) + int(bin(n + 1)[3:4] == "1"))
    want = {r[0]: curve_of((sources[r[3]] * 64 // len(sources), langs[r[2]] * 64 // len(langs), magnitude(len(r[1]) + 1)), 6) for r in rows}
    assert {r.doc_id: r.curve for r in sharding.hilbert_shards(documents(spark, rows)).collect()} == want


def check_shards(rows, got, shards=16):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    counts = Counter(r.shard for r in got)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert set(counts) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    order = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


@pytest.mark.parametrize("clashing", [False, True])
def test_shards_obey_the_law(spark, clashing):
    rows = AWKWARD + [(100 + i, "x" * (i * i % 500), "en" if i % 3 else "de", f"s{i % 5 * (i % 2)}") for i in range(200)]
    check_shards(rows, sharding.hilbert_shards(documents(spark, rows, clashing)).collect())


def test_shards_of_few_and_none(spark):
    check_shards(AWKWARD[:3], sharding.hilbert_shards(documents(spark, AWKWARD[:3])).collect())
    assert sharding.hilbert_shards(documents(spark, [])).count() == 0


def test_a_shard_spans_a_small_box(spark):
    rows = [(i, "x" * (1 << i % 8), "en", f"s{i // 8 % 8:02d}") for i in range(1024)]
    spans = defaultdict(set)
    src = {r[0]: r[3] for r in rows}
    for r in sharding.hilbert_shards(documents(spark, rows)).collect():
        spans[r.shard].add((src[r.doc_id], r.size))
    assert max(map(len, spans.values())) <= 8  # of 64 cells in all


# ---------------------------------------------------------------- mixing


def brute_targets(sizes, weights=(5, 2, 1), passes=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), list(names), {}
    rest = total
    while True:
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] >= passes * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = float(passes * sizes[s])
            rest -= passes * sizes[s]
            open_.remove(s)
        if not open_:
            return target


def words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("clashing", [False, True])
def test_mix_meets_brute_force_targets(spark, clashing):
    rows = AWKWARD + [(100 + i, "w " * (i % 13), "en", f"s{i % 9}") for i in range(300)]
    got = mixing.mix(documents(spark, rows, clashing)).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
    want = brute_targets(dict(sizes))
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r["size"]
        assert len(r.positions) == -(-r.taken // r["size"] if r["size"] else 0)
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mix_agrees_with_itself_and_takes_whole_documents(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 4}") for i in range(200)]
    once, again = ([tuple(r) for r in mixing.mix(documents(spark, rows).repartition(n)).orderBy("doc_id").collect()] for n in (1, 5))
    assert once == again
    for r in mixing.mix(documents(spark, rows), whole=True).collect():
        assert r.taken % r["size"] == 0


def test_mix_of_nothing_and_of_no_words(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    got = mixing.mix(documents(spark, [(1, None), (2, "  ")])).collect()
    assert [(r.target, r.taken, r.positions) for r in got] == [(0.0, 0, [])] * 2


@pytest.mark.parametrize("slope", [-1.0, -0.5, 0.0, 0.8, 1.0])
def test_positions_invert_the_demand(spark, slope):
    target = 1000.0
    rows = spark.createDataFrame([(float(w),) for w in range(0, 1001, 50)], "w double")
    for r in rows.select("w", mixing.position_at(F.col("w"), F.lit(target), ((0, 1 - slope), (1, 1 + slope))).alias("t")).collect():
        assert math.isclose(target * (r.t + slope * (r.t * r.t - r.t)), r.w, abs_tol=1e-6)


@pytest.mark.parametrize("schedule", [((0, 1), (0.25, 3), (0.5, 0), (1, 2)), ((0, 0), (0.3, 0), (0.6, 5), (1, 0)), ((0, 2), (1, 2))])
def test_positions_invert_any_schedule(spark, schedule):
    """The integral of the rate up to the position, by many small steps, is the share of words that are due."""
    import numpy as np

    at = np.linspace(0, 1, 200_001)
    rate = np.interp(at, [t for t, _ in schedule], [r for _, r in schedule])
    demand = np.concatenate(([0], np.cumsum((rate[1:] + rate[:-1]) / 2)))
    demand /= demand[-1]
    rows = spark.createDataFrame([(float(w),) for w in range(0, 1001, 25)], "w double")
    for r in rows.select("w", mixing.position_at(F.col("w"), F.lit(1000.0), schedule).alias("t")).collect():
        assert 0 <= r.t <= 1 and math.isclose(np.interp(r.t, at, demand), r.w / 1000, abs_tol=1e-4)


def test_no_schedule_is_an_error():
    for bad in (((0, 0), (1, 0)), ((0, 1), (0.5, 1)), ((0, -1), (1, 3)), ((0, 1), (0, 2), (1, 1))):
        with pytest.raises(ValueError):
            mixing.position_at(F.lit(1.0), F.lit(2.0), bad)


def test_a_source_may_have_its_own_schedule(spark):
    rows = [(i, "w " * 10, "en", f"s{i % 2}") for i in range(100)]
    late = ((0, 0), (0.9, 0), (1, 1))
    got = mixing.mix(documents(spark, rows), of_source={"s1": late}).collect()
    assert all(r.positions[-1] >= 0.9 for r in got if r.source == "s1" and r.taken) and any(r.positions[0] < 0.5 for r in got if r.source == "s0" and r.taken)


@pytest.mark.parametrize("most", [0, 1, 1000])
def test_rows_that_repeat_a_key_get_a_decision_each(spark, monkeypatch, most):
    monkeypatch.setattr(common, "REPEATS", most)
    docs = spark.createDataFrame([(i % 3, f"t{i}") for i in range(12)] + [(None, "n")] * 5, "id long, text string")
    decided = spark.createDataFrame([(i % 3, i) for i in range(12)] + [(None, 100 + i) for i in range(5)], "id long, at long")
    got = common.attached(docs, common.row_key(F.col("id")), decided, common.row_key(F.col("id")), F.col("at")).select("doc.*", "got").collect()
    assert Counter(r.got for r in got) == Counter([*range(12), *range(100, 105)]) and Counter(r.text for r in got)["n"] == 5
    assert all((r.id is None) == (r.got >= 100) and (r.id is None or r.got % 3 == r.id) for r in got)


def test_copies_come_in_order_of_position(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 4}") for i in range(200)]
    rows += AWKWARD + [(7, "one more word with that id here", "en", "a")]
    docs = documents(spark, rows, clashing=True)
    mixed = mixing.mix(docs, whole=True).collect()
    got = mixing.training_order(docs, whole=True).select("position", "doc.*").collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    assert Counter((r.doc_id, words(r.text)) for r in got) == sum((Counter({(r.doc_id, r["size"]): len(r.positions)}) for r in mixed), Counter())


def test_shards_are_written_apart(spark, tmp_path):
    docs = documents(spark, [(i, f"t{i}", "en", f"s{i % 4}") for i in range(200)])
    sharding.write_shards(sharding.sharded(docs, shards=5).select("shard", "slot", "doc.doc_id"), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {f"shard={i}" for i in range(5)}
    assert Counter(r.shard for r in back.collect()) == Counter(dict.fromkeys(range(5), 40))


def test_sharded_rows_are_whole(spark):
    rows = AWKWARD + [(7, "another text with that id", "en", "a")]
    docs = documents(spark, rows, clashing=True)
    got = sharding.sharded(docs).select("shard", "slot", "doc.doc_id", "doc.text", "doc.fp").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    want = Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in sharding.hilbert_shards(docs).collect())
    assert Counter((r.doc_id, zlib.crc32((r.text or "").encode()), r.shard, r.slot) for r in got) == want
