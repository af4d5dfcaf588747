"""Rows that a task sorts or joins are bounded, and what is staged is computed once."""

from pyspark.sql import functions as F

from statutegraph import storage
from statutegraph.operators import graph, references


def test_rows_are_dealt_to_more_tasks_as_they_grow(spark):
    rows = spark.range(100)
    assert storage.dealt(rows, 100, "id").rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    assert storage.dealt(rows, 20 * storage.TASK_ROWS, "id").rdd.getNumPartitions() == 20


def test_citations_resolve_alike_however_they_are_dealt(spark, monkeypatch):
    pieces = spark.createDataFrame([(d, p, f"제{p % 3 + 1}조(가) 제2조제1항 및 제9조에 따라") for d in range(4) for p in range(5)] + [(9, 0, "머리")], "doc_id long, pos long, article_text string")
    want = sorted(map(tuple, references.resolve(pieces).collect()))
    assert len(want) == 40 and want[0] == (0, 0, 0, "제2조제1항", 1) and want[1] == (0, 0, 1, "제9조", None)
    monkeypatch.setattr(storage, "TASK_ROWS", 2)
    dealt = references.resolve(pieces)
    assert sorted(map(tuple, dealt.collect())) == want
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()


def test_graph_scope_reads_staged_triplets(spark):
    docs = spark.createDataFrame([(1, "t", 1), (2, "t", 2)], "doc_id long, title string, load_seq long")
    articles = spark.createDataFrame([(1, 0, "제1조"), (2, 0, "제1조")], "doc_id long, pos long, article_number string")
    triplets = spark.range(1, 3).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("pos"), *(F.lit(c).alias(c) for c in graph.EDGE), F.lit("제1조").alias("article_number"), F.lit(1.0).alias("confidence"))
    edges = graph.relation_edges_graph_scope(docs, triplets, articles)
    assert "Range (1, 3" not in edges._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id, r.multiplicity) for r in edges.collect()) == [(1, 1), (2, 3)]
