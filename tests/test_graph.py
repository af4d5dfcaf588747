import math
import random

import pytest
from pyspark.sql import functions as F

from statutegraph.operators import articles as art
from statutegraph.operators import dedup, graph, running
from statutegraph.schemas import TRIPLETS

NAN = float("nan")


def folded(rows):
    """The first of a key stays until one with a strictly higher confidence comes."""
    kept = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        key = (r[0], *r[2:5])
        if key not in kept or r[6] > kept[key][6]:
            kept[key] = r
    return kept


def test_dedup_equals_the_fold(spark):
    rng = random.Random(3)
    values = [0.1, 0.5, 0.5, 0.9, NAN]
    rows = [(d, p, f"s{rng.randrange(3)}", "r", f"o{rng.randrange(2)}", f"제{p}조", rng.choice(values)) for d in range(20) for p in range(30)]
    got = {(r.doc_id, r.subject, r.relation, r.object): (r.pos, r.article_number) for r in dedup.dedup_triplets(spark.createDataFrame(rows, TRIPLETS)).collect()}
    want = {k: (r[1], r[5]) for k, r in folded(rows).items()}
    assert got == want


def test_dedup_threshold_is_opt_in(spark):
    rows = spark.createDataFrame([(1, 0, "s", "r", "o", "제1조", 0.0), (1, 1, "s", "r", "p", "제1조", 0.7)], TRIPLETS)
    assert dedup.dedup_triplets(rows).count() == 2
    assert dedup.dedup_triplets(rows, min_confidence=0.5).count() == 1


def saved_one_by_one(docs, articles, triplets):
    """Documents saved in load order into a graph matched by title and number alone."""
    titles, numbers, copies, edges = [], [], {}, {}
    for doc_id, seq, title in sorted(docs, key=lambda d: d[1]):
        titles.append(title)
        for d, pos, number in sorted(articles):
            if d == doc_id:
                copies[d, pos] = titles.count(title)
                numbers += [number] * titles.count(title)
        for t in triplets:
            if t[0] == doc_id and numbers.count(t[5]):
                edges[t[0], t[1]] = numbers.count(t[5])
    return copies, edges


@pytest.mark.parametrize("order", ["dense", "hashed", "uneven"])
@pytest.mark.parametrize("chunks", [3, 128])
def test_graph_scope_equals_saving_one_by_one(spark, monkeypatch, chunks, order):
    monkeypatch.setattr(running.chunk_bounds, "__defaults__", (chunks,))
    rng = random.Random(8)
    seq = {"dense": lambda i: i * 2 + 1, "hashed": lambda i: rng.randrange(-(1 << 63), 1 << 63), "uneven": lambda i: i if i < 9 else 10**17 * i}[order]
    docs = [(i, seq(i), rng.choice("ABC")) for i in range(12)]
    articles = [(i, p, f"제{rng.randrange(3)}조") for i in range(12) for p in range(rng.randrange(4))]
    triplets = [(i, p, "s", "r", "o", f"제{rng.randrange(4)}조", 1.0) for i in range(12) for p in range(3)]
    d = spark.createDataFrame(docs, "doc_id long, load_seq long, title string")
    a = spark.createDataFrame(articles, "doc_id long, pos long, article_number string")
    t = spark.createDataFrame(triplets, TRIPLETS)
    copies, edges = saved_one_by_one(docs, articles, triplets)
    assert {(r.doc_id, r.pos): r.copies for r in graph.contains_graph_scope(d, a).collect()} == copies
    assert {(r.doc_id, r.pos): r.multiplicity for r in graph.relation_edges_graph_scope(d, t, a).collect()} == edges
    in_order, totals, got = [r[0] for r in sorted(docs, key=lambda r: r[1])], None, {}
    for part in (in_order[:5], in_order[5:6], in_order[6:]):  # appends, each with the totals of those before
        own = [x.filter(F.col("doc_id").isin(part)) for x in (d, t, a)]
        found, added = graph.append_graph_scope(*own, totals)
        got |= {(r.doc_id, r.pos): r.multiplicity for r in found.collect()}
        totals = added if totals is None else totals.unionByName(added)
    assert got == edges


def test_edges_dropped_and_entities(spark):
    a = spark.createDataFrame([(1, 0, "제1조"), (1, 1, "제1조"), (2, 0, "제2조")], "doc_id long, pos long, article_number string")
    t = spark.createDataFrame([(1, 0, "갑", "r", "갑", "제1조", 1.0), (1, 1, "을", "r", "병", "제9조", 1.0), (2, 0, "정", "r", "무", "제1조", 1.0)], TRIPLETS)
    edges = graph.relation_edges(t, a)
    assert [(r.subject, r.multiplicity) for r in edges.collect()] == [("갑", 2)]
    assert graph.relation_edges(t, a, expand=True).count() == 2
    assert {r.subject for r in graph.dropped(t, a).collect()} == {"을", "정"}
    assert [r.name for r in graph.entities(edges).collect()] == ["갑"]
    new = graph.new_entities(spark.createDataFrame([("갑",), ("기",), ("기",)], "name string"), graph.entities(edges))
    assert [r.name for r in new.collect()] == ["기"]


def test_context_takes_three_records_before(spark):
    rows = [(1, p, f"제{p}조", f"c{p}") for p in range(5)] + [(2, 0, "제9조", "x")]
    got = {(r.doc_id, r.pos): r.context for r in art.context(spark.createDataFrame(rows, "doc_id long, pos long, article_number string, concept string")).collect()}
    assert got[1, 0] == "없음" and got[2, 0] == "없음"
    assert got[1, 4] == "- 제1조: c1\n- 제2조: c2\n- 제3조: c3"


def test_context_of_one_giant_document_is_dealt_to_several_tasks(spark):
    rows = spark.range(3000).select(F.floor(F.col("id") / 2500).alias("doc_id"), (F.col("id") % 2500).alias("pos"), F.concat(F.lit("제"), "id", F.lit("조")).alias("article_number"), F.col("id").cast("string").alias("concept"))
    plain = {(r.doc_id, r.pos): r.context for r in art.context(rows, chunk=1 << 20).collect()}
    dealt = art.context(rows, chunk=100).withColumn("task", F.spark_partition_id()).collect()
    assert {(r.doc_id, r.pos): r.context for r in dealt} == plain and len(dealt) == 3000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = art.context(rows, chunk=100).filter("doc_id = 0").select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks == 4


def test_bounds_part_any_spread_of_orders(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") < 5000, F.col("id")).otherwise(F.xxhash64("id")).alias("o"))
    bounds = running.chunk_bounds(rows, "o", 16)
    sizes = [r["count"] for r in rows.groupBy(running.chunk_of("o", bounds)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1000
    assert running.chunk_bounds(rows.limit(0), "o") == []


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert [tuple(r) for r in graph.statistics(none, none, none).collect()] == [(0, 0, 0)]


def test_lookup_takes_the_first_and_keeps_what_is_missing(spark):
    a = spark.createDataFrame([(2, 2, 0, "제1조", "b"), (1, 1, 5, "제1조", "a"), (1, 1, 7, "제1조", "c")], "doc_id long, load_seq long, pos long, article_number string, concept string")
    keys = spark.createDataFrame([("제1조",), ("제1조",), ("제8조",)], "article_number string")
    got = {r.article_number: r.concept for r in graph.article_lookup(a, keys).collect()}
    assert got == {"제1조": "a", "제8조": None}


def test_top_entities_break_ties_by_name(spark):
    edges = spark.createDataFrame([("a", "z", 1), ("a", "y", 1), ("a", "x", 3)], "subject string, object string, multiplicity long")
    assert [tuple(r) for r in graph.top_entities(edges, 2).collect()] == [("x", 3), ("y", 1)]


def test_display_rounds_and_cuts(spark):
    t = spark.createDataFrame([(1, p, "가" * 30, "r", "o", "n", 0.126) for p in range(12)], TRIPLETS)
    rows = art.shown_triplets(t).orderBy("pos").collect()
    assert len(rows) == 10 and rows[0].subject == "가" * 20 and rows[0].confidence == "0.13"
    assert math.isclose(float(rows[0].confidence), 0.13)


def test_plan_of_edges_has_no_join_of_all_with_all(spark):
    a = spark.createDataFrame([(1, 0, "제1조")], "doc_id long, pos long, article_number string")
    t = spark.createDataFrame([(1, 0, "갑", "r", "갑", "제1조", 1.0)], TRIPLETS)
    plan = graph.relation_edges(t, a)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert F.lit(1) is not None
