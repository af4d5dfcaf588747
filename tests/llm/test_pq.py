import hashlib
from collections import Counter

import numpy as np
import pytest

from statutegraph.llm import pq
from frames import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """By loops over Python integers."""
    good = [r for r in rows if r[1] and all(x is not None and np.isfinite(np.float32(x)) for x in r[1]) and len(r[1]) % parts == 0]
    if not good:
        return Counter()
    rank = lambda r: (r[0] is None, r[0] or 0, r[3])
    good = [(*r, [max(-pq.LIMIT, min(pq.LIMIT, int(np.floor(float(np.float32(x)) * 256)))) for x in r[1]]) for r in good]
    width = len(min(good, key=rank)[3]) // parts
    good = [r for r in good if len(r[3]) == width * parts]
    cut = lambda v: [tuple(v[i * width : (i + 1) * width]) for i in range(parts)]
    books = [list(b) for b in zip(*(cut(r[3]) for r in sorted(good, key=rank)[:entries]))]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    nearest = lambda x, book: min(range(len(book)), key=lambda i: (far(x, book[i]), i))
    for _ in range(rounds):
        for at, book in enumerate(books):
            groups = {}
            for r in good:
                x = cut(r[3])[at]
                groups.setdefault(nearest(x, book), []).append(x)
            books[at] = [tuple(sum(c) // len(c) for c in zip(*groups[i])) if i in groups else y for i, y in enumerate(book)]
    sha = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    coded = []
    for r in good:
        code = [nearest(x, book) for x, book in zip(cut(r[3]), books)]
        coded.append((r[0], r[2], "".join(f"{c:02x}" for c in code), sum(far(x, book[c]) for x, book, c in zip(cut(r[3]), books, code))))
    total = Counter()
    for r in coded:
        total[r[1]] += r[3]
    return Counter((i, code, error, total[label], sha) for i, label, code, error in coded)


def some(n, dims, seed=0, scale=0.3):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(0, scale, dims)], int(i % 4) or None) for i in range(n)]


@pytest.mark.parametrize("clashing", [False, True])
def test_codes_equal_brute_force(spark, clashing):
    rows = some(300, 32)
    rows += [(400 + i, rows[i][1], 1) for i in range(20)] + [rows[0], rows[0]]
    rows += [(900, None, 1), (901, [], 1), (902, [0.1] * 31 + [None], 1), (903, [0.1] * 31 + [float("nan")], 1), (904, [float("inf")] + [0.1] * 31, 1)]
    rows += [(905, [0.1] * 33, 1), (906, [0.1] * 48, 2), (None, [0.2] * 32, 3), (907, [3e38] + [-3e38] * 31, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = pq.coded_vectors(with_clashes(df) if clashing else df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 37, 65])
def test_few_vectors(spark, n):
    rows = some(n, 16, n)
    assert Counter(map(tuple, pq.coded_vectors(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows)


def test_nothing(spark):
    assert pq.coded_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pq.coded_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("scale", [1, 30, 4000])
@pytest.mark.parametrize("n", [1, 16, 17, 1000, 4097])
def test_two_trees_find_what_all_distances_find(scale, n):
    rng = np.random.default_rng(n)
    points = np.floor(rng.normal(0, scale, (3, n, 4))).astype(np.int64)
    books = np.floor(rng.normal(0, scale, (3, 37, 4))).astype(np.int64)
    books[:, 5] = books[:, 3]  # ties go to the lower one
    got, sums, counts = pq.assigned(pq.Tree(points.reshape(-1, 4), n, pq.LEAF), pq.Tree(books.reshape(-1, 4), 37, 1))
    want = ((points[:, :, None] - books[:, None]) ** 2).sum(-1).argmin(-1) + np.arange(3)[:, None] * 37
    assert (got == want.ravel()).all()
    assert (counts == np.bincount(got, minlength=111)).all()
    every = np.zeros((111, 4), np.int64)
    np.add.at(every, got, points.reshape(-1, 4))
    assert (sums == every).all()


def test_bounds_spare_most_distances_and_whole_nodes_are_assigned(monkeypatch):
    """Points in tight clusters around the entries: no leaf is left uncertain."""
    rng = np.random.default_rng(3)
    book = rng.integers(-10_000, 10_000, (64, 4))
    points = (book[rng.integers(0, 64, 4096)] + rng.integers(-5, 6, (4096, 4))).astype(np.int64)
    left = []
    exact = pq._by_distance
    monkeypatch.setattr(pq, "_by_distance", lambda parts, tree, p, e, *out: (left.append((parts.levels[-1][1][p] * tree.levels[-1][1][e]).sum()), exact(parts, tree, p, e, *out)))
    got, _, _ = pq.assigned(pq.Tree(points, 4096, pq.LEAF), pq.Tree(book, 64, 1))
    assert (got == ((points[:, None] - book) ** 2).sum(-1).argmin(-1)).all()
    assert sum(left) < 4096 * 64 / 10
