"""Every query that has a SQL twin, compared with DuckDB over whole tables."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from shared import FOLDER

# The job queries are compared in test_jobs, the text queries in tests/llm.
SQL = sorted(n for n in oracle_sql() if not n.startswith("job_"))
ORDERED = [n for n in SQL if any(w in n for w in (
    "auc", "precision", "quantile", "rank", "running", "decile", "describe", "stats", "profile", "numeric_cat",
    "histogram", "encoded", "pooled"))]


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", SQL)
def test_equals_sql(spark, con, name):
    assert compare.differences(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", ORDERED)
def test_distributed_way_equals_sql(spark, con, name, tiny_tasks):
    assert compare.differences(spark, con, name, FOLDER) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["feature_1", "feature_2", "n_combinations", "min_rate", "max_rate", "rate_range", "weighted_std"]
    assert df.count() >= 0


def test_comparison_notices_a_difference(spark, con, monkeypatch):
    wrong = {**oracle_sql(), "roc_auc": oracle_sql()["roc_auc"].replace("+ 1) / 2", "+ 3) / 2")}
    monkeypatch.setattr(compare, "oracle_sql", lambda: wrong)
    assert compare.differences(spark, con, "roc_auc", FOLDER) is not None
