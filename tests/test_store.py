"""Saves that meet, merging, sums, lookups of a stored graph."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from statutegraph.operators import graph
from statutegraph.plans import corpus
from statutegraph.schemas import DOCUMENTS
from statutegraph.sources import files, store
from statutegraph.streaming import arrivals

TEXT = "제1조(목적) 이 법은 제2조제1항에 따라 고시로 정한다.\n\n제2조(정의) 하여야 한다."


def docs(spark, ids, seq=None, text=TEXT):
    return spark.createDataFrame([(i, i if seq is None else seq, f"법{i % 2}", f"제{i}호", text.replace("제2조(정의)", f"제{i + 2}조(정의)")) for i in ids], DOCUMENTS)


def content(spark, path):
    g = store.load(spark, path)
    return {name: sorted(map(repr, getattr(g, name).drop("created_at").collect())) for name in store.TABLES}


def equal_to_one_save(spark, tmp_path, path, ids):
    whole = str(tmp_path / "whole")
    store.save(corpus.build(docs(spark, ids)), whole, clear=True)
    assert content(spark, path) == content(spark, whole)


def test_one_of_many_creates_a_file(spark, tmp_path):
    won = []
    tries = [threading.Thread(target=lambda i=i: files.publish(spark, str(tmp_path), "0.json", str(i)) and won.append(i)) for i in range(12)]
    for x in tries:
        x.start()
    for x in tries:
        x.join()
    assert len(won) == 1 and (tmp_path / "0.json").read_text() == str(won[0])
    assert os.listdir(tmp_path) == ["0.json"] or all(n.startswith(".") or n == "0.json" for n in os.listdir(tmp_path))


def test_two_streams_and_a_batch_at_once_keep_every_document(spark, tmp_path):
    path = str(tmp_path / "g")
    for name, ids in (("a", [1, 2, 3]), ("b", [3, 4, 5])):
        for i in ids:
            docs(spark, [i]).coalesce(1).write.parquet(str(tmp_path / name / str(i)))
    start = lambda name, state: arrivals.append_stream(arrivals.arriving(spark, str(tmp_path / name / "*"), max_files=2), path, str(tmp_path / state))
    running = [start("a", "state-a"), start("b", "state-b")]
    store.save(corpus.build(docs(spark, [5, 6, 1])), path)
    for q in running:
        q.awaitTermination()
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3, 4, 5, 6])
    before = content(spark, path)
    start("a", "another-state").awaitTermination()  # the same documents under batch numbers that others had
    assert content(spark, path) == before
    docs(spark, [7]).coalesce(1).write.parquet(str(tmp_path / "a" / "7"))
    start("a", "state-a").awaitTermination()
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3, 4, 5, 6, 7])


def test_a_batch_of_another_stream_replaces_nothing(spark, tmp_path):
    path = str(tmp_path / "g")
    store.save_batch(corpus.build(docs(spark, [1])), path, 0, "one")
    store.save_batch(corpus.build(docs(spark, [2])), path, 0, "two")
    store.save_batch(corpus.build(docs(spark, [9])), path, 0, "two")  # ran before
    equal_to_one_save(spark, tmp_path, path, [1, 2])


def test_a_save_that_loses_the_race_takes_out_what_the_other_brought(spark, tmp_path, monkeypatch):
    path, real, raced = str(tmp_path / "g"), store._commit, []

    def commit(spark_, path_, version, **entry):
        if not raced:
            raced.append(version)
            store.save(corpus.build(docs(spark, [2, 3])), path)
        return real(spark_, path_, version, **entry)

    monkeypatch.setattr(store, "_commit", commit)
    store.save(corpus.build(docs(spark, [1, 2])), path)
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3])
    assert [c["documents"] for c in store.state(spark, path).counts.values()] == [2, 1]


def test_a_clear_that_comes_between_keeps_what_is_saved_after_it(spark, tmp_path, monkeypatch):
    path, real, raced = str(tmp_path / "g"), store._commit, []
    store.save(corpus.build(docs(spark, [1])), path)

    def commit(spark_, path_, version, **entry):
        if not raced:
            raced.append(version)
            store.save(corpus.build(docs(spark, [3])), path, clear=True)
        return real(spark_, path_, version, **entry)

    monkeypatch.setattr(store, "_commit", commit)
    store.save(corpus.build(docs(spark, [1, 2])), path)
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3])


def test_merging_bounds_the_folders_and_changes_no_row(spark, tmp_path):
    path = str(tmp_path / "g")
    most = 0
    for i in range(9):
        store.save_batch(corpus.build(docs(spark, [i, i + 1])), path, i, "s", compact_every=3)
        most = max(most, len(store.state(spark, path).saves))
    assert most <= 5
    equal_to_one_save(spark, tmp_path, path, range(10))
    store.compact(spark, path, everything=True)
    assert len(store.state(spark, path).saves) == 1 and store.state(spark, path).streams == {"s": 8}
    assert store.vacuum(spark, path, older_than=0) > 0
    for name in (*store.TABLES, "tallies"):
        assert len([n for n in os.listdir(f"{path}/{name}") if n.startswith("save=")]) == 1
    assert len([n for n in os.listdir(f"{path}/saves") if n.endswith(".json") and not n.startswith(".")]) == 1
    equal_to_one_save(spark, tmp_path, path, range(10))
    store.save_batch(corpus.build(docs(spark, [77])), path, 8, "s")  # known though its commit is gone
    equal_to_one_save(spark, tmp_path, path, range(10))


def test_a_save_during_a_merge_stays_beside_it(spark, tmp_path, monkeypatch):
    path, real, raced = str(tmp_path / "g"), store._commit, []
    for i in (1, 2):
        store.save(corpus.build(docs(spark, [i])), path)

    def commit(spark_, path_, version, **entry):
        if not raced and entry["kind"] == "merge":
            raced.append(version)
            store.save(corpus.build(docs(spark, [3])), path)
        return real(spark_, path_, version, **entry)

    monkeypatch.setattr(store, "_commit", commit)
    store.compact(spark, path, everything=True)
    assert len(store.state(spark, path).saves) == 2
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3])


def test_small_saves_are_merged_without_large_ones():
    now = store.State(saves=list("abcd"), counts={x: {"articles": n} for x, n in zip("abcd", (1000, 5, 3, 4))})
    assert sorted(store._small_ones(now)) == ["b", "c", "d"]
    assert store._small_ones(store.State(saves=["a"], counts={"a": {}})) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_are_looked_for_in_their_buckets_and_stored_rows_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "g")
    store.save(corpus.build(docs(spark, range(20))), path)
    now = store.state(spark, path)
    stored = store._table(spark, path, now, "entities")
    names = spark.createDataFrame([("제1조",), ("새 이름",)], "name string")
    new = store.new_names(names, stored)
    assert [r.name for r in new.collect()] == ["새 이름"]
    plan = plan_of(new)
    at = plan.index("FileScan")
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    above = plan[:at].splitlines()
    scan_depth = len(above[-1]) - len(above[-1].lstrip(" :+-*"))
    line = next(x for x in reversed(above) if "Exchange hashpartitioning" in x or "BroadcastHashJoin" in x)
    assert "BroadcastHashJoin" in line and scan_depth > 0, plan  # filtered before anything moves
    touched = {r[0] for r in names.select(store.bucket()).collect()}
    read = {r[0].split("bucket=")[1].split("/")[0] for r in stored.filter(F.col("bucket").isin(list(touched))).select(F.input_file_name()).collect()}
    assert read <= {str(b) for b in touched}


def test_too_many_names_meet_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "BROADCAST_ROWS", 1)
    path = str(tmp_path / "g")
    store.save(corpus.build(docs(spark, [1, 2])), path)
    store.save(corpus.build(docs(spark, [2, 3])), path)
    equal_to_one_save(spark, tmp_path, path, [1, 2, 3])


def test_sums_answer_without_reading_an_edge(spark, tmp_path):
    path = str(tmp_path / "g")
    for i in range(3):
        store.save(corpus.build(docs(spark, [i, i + 1, 50 + i])), path)
    store.compact(spark, path)
    store.save(corpus.build(docs(spark, [60])), path)
    g = store.load(spark, path)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(store.top_entities(spark, path)) == rows(graph.top_entities(g.relations))
    assert rows(store.edges_by_subject(spark, path)) == rows(graph.edges_by_subject(g.relations))
    assert rows(store.relation_counts(spark, path)) == rows(g.relations.groupBy("relation").agg(F.sum("multiplicity").alias("edges")))
    want = graph.statistics(g.documents, g.articles, g.entities, relations=g.relations).first()
    assert tuple(store.statistics(spark, path).first())[:4] == tuple(want)
    for df in (store.top_entities(spark, path), store.edges_by_subject(spark, path), store.statistics(spark, path)):
        assert all("/tallies/" in f for f in df.inputFiles())


def scanned_rows(df):
    """Rows that the scans of a plan gave out."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "g")
    text = "\n\n".join(f"제{n}조(제목{n}) 제{n}조제1항에 따라 하여야 한다." for n in range(1, 200))
    for i in range(3):
        store.save(corpus.build(docs(spark, range(10 * i, 10 * i + 10), text=text)), path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many files as a large table has
    try:
        store.compact(spark, path, everything=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    g = store.load(spark, path)
    found = g.relations.filter(F.col("article") == "제57조")
    n, read = g.relations.count(), scanned_rows(found)
    assert found.count() == 60 and read <= n / 2
    assert scanned_rows(g.relations.filter(F.col("article") == "제57조 ")) <= n / 2
    (row,) = store.article_lookup(spark, path, ["제57조"]).collect()
    assert (row.doc_id, row.pos, row.concept) == (0, 56, "제목57")
    assert store.relations_of(spark, path, ["제57조", "없음"]).count() == 60
    (none,) = store.article_lookup(spark, path, ["제999조"]).collect()
    assert none.doc_id is None


def test_other_columns_than_before_are_an_error(spark, tmp_path):
    path = str(tmp_path / "g")
    store.save(corpus.build(docs(spark, [1])), path)
    other = corpus.build(docs(spark, [2]))
    other.articles = other.articles.withColumn("more", F.lit(1))
    with pytest.raises(ValueError, match="articles has other columns"):
        store.save(other, path)
    equal_to_one_save(spark, tmp_path, path, [1])


def test_the_latest_version_of_a_document_counts_and_the_others_are_told(spark, tmp_path):
    rows = docs(spark, [1], 5, "제1조(옛) 가").unionByName(docs(spark, [1], 7, "제1조(새) 나")).unionByName(docs(spark, [1], 7, "제1조(새) 나")).unionByName(docs(spark, [2], 1))
    chosen, others = arrivals.latest_versions(rows.repartition(3))
    assert sorted((r.doc_id, r.load_seq, r.content[:6]) for r in chosen.collect()) == [(1, 7, "제1조(새)"), (2, 1, "제1조(목적"[:6])]
    assert [tuple(r) for r in others.collect()] == [(1, None, "arrive", "superseded by load_seq 7")]
    tie = docs(spark, [3], 1, "제1조(가)").unionByName(docs(spark, [3], 1, "제1조(나)"))
    first = {arrivals.latest_versions(tie.repartition(n))[0].first().content for n in (1, 2, 3)}
    assert len(first) == 1
    rows.write.parquet(str(tmp_path / "in" / "x"))
    path = str(tmp_path / "g")
    arrivals.append_stream(arrivals.arriving(spark, str(tmp_path / "in" / "*")), path, str(tmp_path / "state")).awaitTermination()
    g = store.load(spark, path)
    assert [tuple(r) for r in g.errors.collect()] == [(1, None, "arrive", "superseded by load_seq 7")]
    assert {r.concept for r in g.articles.filter("doc_id = 1").collect()} == {"새"}


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_wording_is_gone_through_once_and_moves_no_text(spark):
    graph = corpus.build(docs(spark, [1, 2]))
    plan = _plan(graph.relations)
    assert "regexp_extract_all" not in plan and "article_text" not in plan
    assert "article_text" not in _plan(graph.contains)
    assert sorted(graph.articles.columns) == sorted(corpus.records(corpus.art.articles(docs(spark, [1]), "heading")).columns)


def test_documents_there_are_sent_to_the_rows(spark, tmp_path, monkeypatch):
    """Articles stay where they are, however many documents arrive."""
    ids = spark.range(0, 1000).select(F.col("id").alias("doc_id"))
    there = ids.filter("doc_id = 7")
    rows = spark.range(0, 1000).select((F.col("id")).alias("doc_id"), F.lit("t").alias("article_text")).unionByName(spark.sql("SELECT CAST(NULL AS LONG) AS doc_id, 'n' AS article_text"))
    monkeypatch.setattr(store, "BROADCAST_ROWS", 10)
    left = store._of_new(rows, ids, there)
    assert "SortMergeJoin" not in _plan(left) and "Exchange hashpartitioning" not in _plan(left)
    assert left.count() == 999
    monkeypatch.setattr(store, "BROADCAST_ROWS", 0)
    assert store._of_new(rows, ids, there).count() == 999


def test_a_number_that_stands_everywhere_fills_no_task_of_a_lookup(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "graph")
    store.save(corpus.build(docs(spark, [3, 1, 2])), path)
    (number,) = store.load(spark, path).articles.filter("doc_id = 1 AND pos = 0").select("article_number").first()
    plans = []
    monkeypatch.setattr(store, "kept", lambda df, name, real=store.kept: plans.append(_plan(df)) or real(df, name))
    found = store.article_lookup(spark, path, [number, "제99조", number])
    assert [(r.article_number, r.doc_id, r.pos) for r in found.orderBy("doc_id").collect()] == [("제99조", None, None), (number, 1, 0)]
    assert "full_text" not in plans[0].split("== Physical Plan ==")[1]
    assert "SortMergeJoin" not in _plan(found)


def test_documents_that_come_once_are_not_digested(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (None, 1, "c")], "doc_id long, load_seq long, content string")
    chosen, others = arrivals.latest_versions(rows)
    assert "sha2" not in _plan(chosen) and "Exchange" not in _plan(chosen)
    assert chosen.count() == 3 and others.count() == 0
    again = rows.unionByName(spark.createDataFrame([(2, 5, "d"), (None, 0, "e")], rows.schema))
    chosen, others = arrivals.latest_versions(again)
    assert sorted(chosen.select("content").toPandas()["content"]) == ["a", "c", "d"]
    assert sorted(r.message for r in others.collect()) == ["superseded by load_seq 1", "superseded by load_seq 5"]


def test_an_empty_table_needs_no_python(spark):
    assert "PythonRDD" not in _plan(store._read(spark, "/nowhere", "errors", [], store.ERRORS)) and store._read(spark, "/nowhere", "errors", [], store.ERRORS).count() == 0
    assert store._read(spark, "/nowhere", "errors", [], store.ERRORS).schema.simpleString() == "struct<doc_id:bigint,pos:bigint,stage:string,message:string>"
    assert "Scan ExistingRDD" not in _plan(store._read(spark, "/nowhere", "errors", [], store.ERRORS))
