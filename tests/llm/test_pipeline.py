from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from frames import AWKWARD, documents

BASE = ["the quick brown fox jumps over the lazy dog and runs away from it", "ein schneller brauner Fuchs springt ja über den faulen Hund und läuft davon"]


def table(spark, tmp_path, clashing=False):
    rows = [(1000 + i, " ".join(f"{w}{i}" if j % 3 == 0 else w for j, w in enumerate((BASE[i % 2] + " ") .split() * 6)), ("en", "de")[i % 2], f"s{i % 4}") for i in range(80)]
    rows += [(2000, rows[0][1], "en", "s0"), (2001, rows[0][1] + " more", "en", "s1"), (2002, "alpha beta gamma delta epsilon zeta eta " + rows[3][1].upper()[:40], "en", "s2")]
    docs = documents(spark, AWKWARD + rows, clashing)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet"))


@pytest.mark.parametrize("clashing", [False, True])
def test_stages_do_what_they_decide(spark, tmp_path, clashing):
    docs = table(spark, tmp_path, clashing)
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(cp.STAGES):
        path = str(tmp_path / f"stage{i}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(cp.STAGES) - 1:
            assert docs.columns == columns
        kept.append(Counter(r.doc_id for r in docs.select("doc_id").collect()))
    language, near, clean, mixed, sharded = kept
    assert not {2, 3, 6, 10} & set(language) and {1, 4, 5, 7, 9, None, 1000} <= set(language) and language[7] == 2
    assert not {5, 2000, 2001} & set(near) and near[7] == 1 and {1, 4, 9, None, 1000} <= set(near)
    assert clean == near - Counter([2002])
    assert set(mixed) <= set(clean) and max(mixed.values()) <= 3
    assert sharded == mixed
    ours = [c for c in docs.columns if c not in columns]
    assert docs.columns == columns + ours and [c.rstrip("_") for c in ours] == ["shard", "slot", "curve"]
    places = docs.select(*ours[:2]).collect()
    assert len(set(places)) == len(places) and {s for s, _ in places} <= set(range(16))


def test_run_equals_the_stages(spark, tmp_path):
    docs = table(spark, tmp_path)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    names = sorted(docs.columns)
    rows = lambda df: Counter(map(tuple, df.select(*names).collect()))
    assert rows(cp.run(spark, str(tmp_path))) == rows(docs)


def test_empty_table_passes_through(spark, tmp_path):
    docs = table(spark, tmp_path).filter(F.lit(False))
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
