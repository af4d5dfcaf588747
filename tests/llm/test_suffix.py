import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from frames import AWKWARD, documents
from statutegraph.llm import suffix

N = suffix.LENGTH


def brute(rows):
    """By a dictionary of all strings."""
    first = {}
    texts = [(r[0] if r[0] is not None else float("inf"), (r[1] or "").encode()) for r in rows]
    for i, t in texts:
        for s in range(len(t) - N + 1):
            w = t[s : s + N]
            first[w] = min(first.get(w, i), i)
    out = Counter()
    for r, (i, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for s in range(len(t) - N + 1):
            if first[t[s : s + N]] < i:
                gone[s : s + N] = b"\x01" * N
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[r[0], len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept] += 1
    return out


def check(spark, rows, clashing=False, parts=3):
    got = suffix.without_repeats(documents(spark, rows, clashing).repartition(parts))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert Counter((*r[:5], bytes(r[5])) for r in got.collect()) == brute(rows)


def planted(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß漢") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(k)) for k in (8, 10, 12, 20, 40, 200)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(" ".join(word() for _ in range(rng.randrange(30))))
            parts.append(rng.choice(passages + ["", "a" * rng.randrange(300), "ab" * rng.randrange(80)]))
        docs.append((i, "".join(parts)))
    docs += [(n + i, docs[rng.randrange(n)][1]) for i in range(10)]
    return docs


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_documents(spark, clashing):
    long = " ".join(str(i * 7919) for i in range(20_000))
    edge = "".join(chr(97 + i % 26) + str(i) for i in range(60))
    more = [(20, long), (21, "x" + long[:60_000] + "y" + long[60_000:]), (None, long[100:300]), (22, edge[:49]), (23, edge[:50]), (24, edge[:50]), (25, edge[1:51]), (26, edge[:51]), (26, edge), (26, edge)]
    check(spark, AWKWARD + more + [(30, "z" * 5000), (31, "z" * 49), (32, "z" * 50), (33, "z" * 51 + "a" + "z" * 60)], clashing)


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, seed):
    check(spark, planted(seed))


def test_small_blocks_buckets_pieces_slabs_and_hot_anchors(spark, monkeypatch):
    for name, value in (("BLOCK_BYTES", 3000), ("BUCKET_BYTES", 4000), ("PIECE", 700), ("SLAB", 500), ("HOT", 5)):
        monkeypatch.setattr(suffix, name, value)
    rows = planted(9)
    blocks = [b.to_pylist() for b in suffix._blocks(iter([_arrow(rows)]))]
    assert len(blocks) > 5
    got = run_locally(rows)
    assert got == brute(rows)
    monkeypatch.setattr(suffix, "HOT", 10**9)
    assert run_locally(rows) == got


def _arrow(rows):
    import pyarrow as pa

    return pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["id", "text"])


def run_locally(rows):
    """The steps of without_repeats() one after another, with the limits as they are set here."""
    import pyarrow as pa

    def grouped(tables, key):
        whole = pa.concat_tables(tables)
        return {k: whole.filter(pa.compute.equal(whole.column(key), k)) for k in sorted(set(whole.column(key).to_pylist()))}

    blocks = pa.Table.from_batches(suffix._blocks(iter([_arrow(rows)])))
    blocks = blocks.append_column("block", pa.array(range(100, 100 + blocks.num_rows)))
    buckets = 1 + sum(len((r[1] or "").encode()) for r in rows) // suffix.BUCKET_BYTES
    found = [pa.Table.from_batches([b]) for b in suffix._block_anchors(buckets)(iter(blocks.to_batches()))]
    shared = grouped([suffix._shared_anchors(t) for t in grouped(found, "bucket").values()], "block")
    around = [suffix._to_buckets(buckets)(t, shared[k]) for k, t in grouped([blocks], "block").items() if k in shared]
    cut = grouped([suffix._in_bucket(t) for t in grouped(around, "bucket").values()], "block")
    none = pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], ["block", "spans"])
    done = pa.concat_tables([suffix._cut(True)(t, cut.get(k, none)) for k, t in grouped([blocks], "block").items()])
    return Counter(tuple(r.values()) for r in done.to_pylist())


def test_nothing(spark):
    assert suffix.without_repeats(documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_in_two_stages_is_sorted(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(97, 97 + [1, 2, 3, 5, 26, 150][seed], (60, suffix.ROW)).astype(np.uint8)
    rows[40:50, 10:] = rows[20:30, 10:]
    rows[50:55, :70] = rows[20:25, 2:72]
    wanted = (rng.random(rows.shape) < [1, 1, 0.5, 0.1, 1, 1][seed]) & (np.arange(suffix.ROW) <= suffix.ROW - N)
    order = suffix.suffix_array(rows, wanted)
    assert sorted(order) == list(np.flatnonzero(wanted.ravel()))
    strings = [bytes(rows[i // suffix.ROW, i % suffix.ROW :])[:N] for i in order]
    assert strings == sorted(strings)
    data = np.concatenate([rows.ravel(), np.zeros(N, np.uint8)])
    shared = suffix.common_prefixes(data, order)
    whole = [bytes(data[i : i + N]) for i in order]
    assert shared[0] == 0 and all(k == next((j for j in range(N) if a[j] != b[j]), N) for k, a, b in zip(shared[1:], whole, whole[1:]))


def test_only_small_suffixes_are_sorted_directly(monkeypatch):
    text = np.frombuffer(b"the quick brown fox jumps over the lazy dog " * 40, np.uint8)[: 20 * suffix.ROW].reshape(-1, suffix.ROW)
    seen = []
    direct = suffix.sorted_directly
    monkeypatch.setattr(suffix, "sorted_directly", lambda d, at, depth: (seen.append(at), direct(d, at, depth))[1])
    suffix.suffix_array(text, np.ones(text.shape, bool))
    (at,) = seen
    tail = lambda i: bytes(text[i // suffix.ROW, i % suffix.ROW :])
    assert set(at) == {i for i in range(text.size) if tail(i) < (tail(i + 1) if (i + 1) % suffix.ROW else b"")} and len(at) < 0.6 * text.size
