"""Every registered query of the engine against its SQL in DuckDB."""

from __future__ import annotations

import pytest

from siltworks.plans.catalog import QUERIES, SQL

from .conftest import SF, rows

EMPTY = {"max_examples_compat"}  # may be empty at this size


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).to_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got) or name in EMPTY


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_budget_forms_agree(spark):
    two, one = (QUERIES[n](spark, SF).select("doc_id").toPandas().doc_id for n in ("budget_prefix", "budget_window"))
    assert set(two) == set(one)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_do_not_read_texts(spark, tmp_path):
    """Only paths and sizes: the text column stays in the file."""
    from siltworks.operators import report

    spark.createDataFrame([("o/r", "a.ts", "x" * 10, 10)], "full_name string, rel_path string, text string, size_bytes long").write.parquet(str(tmp_path / "f"))
    schema = _plan(report.by_category(spark.read.parquet(str(tmp_path / "f")))).split("ReadSchema:")[1]
    assert "text" not in schema


def test_top_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["top_ext"](spark, SF))


def test_entry():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
