import os

import pytest

from statutegraph.operators import graph
from statutegraph.plans import corpus
from statutegraph.schemas import DOCUMENTS, PDF_META, PDF_PAGES
from statutegraph.sources import exports, pdf, store
from statutegraph.streaming import arrivals

TEXT = "제1조(목적) 이 법은 제2조제1항에 따라 고시로 정한다.\n\n제2조(정의) 하여야 한다."


def docs(spark, ids):
    return spark.createDataFrame([(i, i, f"법{i % 2}", f"제{i}호", TEXT) for i in ids], DOCUMENTS)


def counts(spark, path):
    g = store.load(spark, path)
    return [tuple(r) for r in graph.statistics(g.documents, g.articles, g.entities).collect()][0] + (g.relations.count(),)


def test_list_files(spark, tmp_path):
    for name in ("b.PDF", "a.pdf", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.pdf").write_bytes(b"x")
    assert sorted(os.path.basename(r.path) for r in pdf.list_files(spark, str(tmp_path)).collect()) == ["a.pdf", "b.PDF"]
    assert pdf.list_files(spark, str(tmp_path / "absent")).count() == 0


def test_pages_and_documents(spark):
    pages = [("/a.pdf", 2, " 둘 "), ("/a.pdf", 1, "하나\n"), ("/a.pdf", 3, " \n"), ("/b.v1.pdf", 1, "  "), ("/c.pdf", 1, None)]
    meta = [("/a.pdf", "", None, "주제", 3, "a.pdf", None), ("/b.v1.pdf", None, None, "", 1, "b.v1.pdf", None), ("/d.pdf", "t", "", "", 0, "d.pdf", None), ("/e.pdf", "", "", "", 0, "e.pdf", "broken")]
    p, m = spark.createDataFrame(pages, PDF_PAGES), spark.createDataFrame(meta, PDF_META)
    contents = pdf.assemble_pages(p, m)
    got = {r.path: (r.title, r.law_number, r.content) for r in pdf.documents(m, contents).collect()}
    assert got == {"/a.pdf": ("주제", "PDF 문서 - a.pdf", "하나\n\n\n 둘"), "/b.v1.pdf": ("b.v1", "PDF 문서 - b.v1.pdf", ""), "/d.pdf": ("t", "PDF 문서 - d.pdf", "")}
    assert [tuple(r) for r in pdf.failures(m).collect()] == [("/e.pdf", "metadata", "broken")]
    assert corpus.pdf_documents(m, p).count() == 3
    some = p.filter("path <> '/a.pdf'")
    assert [tuple(r) for r in pdf.failures(m, some).orderBy("path").collect()] == [("/a.pdf", "text", "no page could be read"), ("/e.pdf", "metadata", "broken")]
    assert corpus.pdf_documents(m, some).count() == 2
    assert [(r.title, r.author, r.pages) for r in pdf.described(m).filter("path = '/e.pdf'").collect()] == [("", "", 0)]


@pytest.mark.parametrize("mode", ["citation", "heading"])
@pytest.mark.parametrize("clean", [False, True])
def test_articles_of_pages_equal_those_of_the_assembled_text(spark, mode, clean):
    import random

    from pyspark.sql import functions as F

    from statutegraph.functions import text as t

    rng = random.Random(5)
    bits = ["제", "제 1", "제1조", "조", "의", "2", "의2", "제3항", "(", "(제목)", " ", "\n", "글", "가나 ", "제2조(뜻) 글", "１２", "\u00a0", "항"]
    pages = [(f"/{f}.pdf", n, "".join(rng.choice(bits) for _ in range(rng.randrange(7)))) for f in range(150) for n in range(rng.randrange(1, 7))] + [("/x.pdf", 0, None), ("/y.pdf", 3, " \n"), ("/y.pdf", 4, "")]
    p = spark.createDataFrame(pages, PDF_PAGES)
    content = F.col("content")
    whole = pdf.assemble_pages(p).select("path", F.posexplode(t.split_articles(t.clean_text(content) if clean else content, mode)).alias("pos", "article_text"))
    assert sorted(map(tuple, pdf.page_articles(p, mode, clean).collect())) == sorted(map(tuple, whole.collect()))


def test_listings_survive_the_trip(spark, tmp_path):
    rows = [("법", "제1조", "뜻, 목적", None, "한다", None, '“큰, "따옴표"” 글\n둘째 줄 ')]
    listing = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in exports.ARTICLE_COLUMNS))
    exports.write_articles(listing, str(tmp_path / "a"))
    assert [tuple(r) for r in exports.read_articles(spark, str(tmp_path / "a")).collect()] == rows
    edges = spark.createDataFrame([("이 법", "정의함", "갑, 을")], "subject string, relation string, object string")
    exports.write_edges(edges, str(tmp_path / "e"))
    assert [tuple(r) for r in exports.read_edges(spark, str(tmp_path / "e")).collect()] == [("이 법", "정의함", "갑, 을")]


def test_byte_order_mark_and_missing_last_newline(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿d.title,a.number,a.concept,a.subject,a.action,a.object,a.full_text\n법,제1조,목적,,,,\"글, 글\"\n".encode())
    (tmp_path / "e.tsv").write_bytes("주체\t관계유형\t대상\n이 법\t정의함\t목적\n이 법\t요구함\t적용".encode())
    (row,) = exports.read_articles(spark, str(tmp_path / "a.csv")).collect()
    assert (row.title, row.subject, row.full_text) == ("법", None, "글, 글")
    assert exports.read_edges(spark, str(tmp_path / "e.tsv")).count() == 2


def test_save_clear_skip_append(spark, tmp_path):
    path = str(tmp_path / "g")
    store.save(corpus.build(docs(spark, [1, 2])), path, clear=True)
    first = counts(spark, path)
    assert first[:2] == (2, 4)
    store.save(corpus.build(docs(spark, [1, 2])), path)
    assert counts(spark, path) == first
    store.save(corpus.build(docs(spark, [2, 3])), path)
    assert counts(spark, path)[:3] == (3, 6, first[2])
    store.save(corpus.build(docs(spark, [3])), path, on_duplicate="append")
    assert counts(spark, path)[:3] == (4, 8, first[2])
    store.save(corpus.build(docs(spark, [9])), path, clear=True)
    assert counts(spark, path)[:2] == (1, 2)


@pytest.mark.parametrize("clear", [False, True])
@pytest.mark.parametrize("breaks_at", ["articles", "entities", "relations", "saves"])
def test_a_save_that_breaks_off_is_repeated_whole(spark, tmp_path, monkeypatch, clear, breaks_at):
    path = str(tmp_path / "g")
    store.save(corpus.build(docs(spark, [1, 2])), path)
    before, real = counts(spark, path), store.table_path

    def broken(path, name, save=None):
        if name == breaks_at and (save or broken.reads > 1):
            raise OSError("lost")
        broken.reads += name == breaks_at
        return real(path, name, save)

    broken.reads = 1 if breaks_at == "saves" else 0
    graph_ = corpus.build(docs(spark, [2, 3]))
    monkeypatch.setattr(store, "table_path", broken)
    with pytest.raises(OSError):
        store.save(graph_, path, clear=clear)
    monkeypatch.setattr(store, "table_path", real)
    assert counts(spark, path) == before
    store.save(graph_, path, clear=clear)
    got = counts(spark, path)
    assert got[:2] == ((2, 4) if clear else (3, 6))
    store.save(graph_, path, clear=clear)
    assert counts(spark, path) == got


def test_no_graph_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.load(spark, str(tmp_path / "none"))


def test_streams_equal_the_batch(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "g")
    docs(spark, [1, 2, 3]).coalesce(1).write.parquet(str(source / "one"))
    arriving = lambda: arrivals.arriving(spark, str(source / "*"), max_files=1)
    arrivals.append_stream(arriving(), path, str(tmp_path / "state")).awaitTermination()
    docs(spark, [3, 4]).coalesce(1).write.parquet(str(source / "two"))
    arrivals.append_stream(arriving(), path, str(tmp_path / "state")).awaitTermination()
    whole = str(tmp_path / "whole")
    store.save(corpus.build(docs(spark, [1, 2, 3, 4])), whole, clear=True)
    assert counts(spark, path) == counts(spark, whole)
    before = counts(spark, path)
    store.save_batch(corpus.build(docs(spark, [3, 4])), path, 1)  # a batch that runs again
    assert counts(spark, path) == before
    arrivals.split_stream(arriving(), str(tmp_path / "out"), str(tmp_path / "state2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_scored_plan(spark):
    import pandas as pd

    entity = lambda s: pd.Series(['{"article_number":"제1조","concept":"뜻","full_text":"글"}'] * len(s))
    relation = lambda s: pd.Series(['[{"subject":"갑","relation":"정의함","object":"을","article_number":"제1조"}]'] * len(s))
    entities, triplets, errors = corpus.scored(docs(spark, [1]), entity, relation, mode="heading")
    assert errors.count() == 0
    g = corpus.build(docs(spark, [1]), entities, triplets)
    assert [(r.subject, r.multiplicity) for r in g.relations.collect()] == [("갑", 2)]


def test_errors_of_scorers_are_kept(spark):
    import pandas as pd

    def entity(s):
        if s.str.contains("고시").any():
            raise ValueError("no answer")
        return pd.Series(['{"article_number":"제2조","concept":"뜻","full_text":"글"}'] * len(s))

    def relation(s):
        return pd.Series(["{" if "조항: 제2조" in p else '[{"subject":1}]' for p in s])

    entities, triplets, errors = corpus.scored(docs(spark, [1]), entity, relation, mode="heading")
    assert triplets.count() == 0 and {r.article_number for r in entities.collect()} == {"Unknown", "제2조"}
    assert sorted((r.pos, r.stage, r.message) for r in errors.collect()) == [(0, "extract entity", "ValueError: no answer"), (0, "validate", "invalid item"), (1, "parse", "no JSON")]
