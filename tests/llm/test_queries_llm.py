from collections import Counter

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from oracle import connect, same
from statutegraph.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name])


def test_registered_names():
    import __spark_entry__ as e

    assert set(queries.QUERIES) <= set(e.queries()) and set(queries.ORACLES) <= set(e.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_hilbert", "op5_chat", "op7_mixing"])
def test_native_plans_hold_no_python(spark, sf_dir, name, monkeypatch):
    """Neither the last plan nor those of the tables staged before it."""
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: plans.append(plan(self._df)) or write(self, *a, **k))
    plans.append(plan(queries.QUERIES[name](spark, sf_dir)))
    assert name == "op5_chat" or len(plans) > 1
    assert not any(x in p for p in plans for x in ("Python", "Pandas", "Arrow"))


def test_warc_query_revisits_no_small_page(spark, sf_dir):
    rows = queries.op2_warc(spark, sf_dir).collect()
    assert Counter(r.record_type for r in rows)["response"] > 0
    assert all((r.refers_to is None) == (r.record_type == "response") for r in rows)
