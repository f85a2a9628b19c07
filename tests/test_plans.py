"""Plans are the ones meant: pruned scans, no cross joins, no Python, no whole-table sort task."""

import re

import pytest
from pyspark.sql import functions as F

from propensity.catalog import QUERIES
from propensity.operators import folds, metrics, order, rates
from propensity.sources import frames


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


ROWWISE = ["features_v1", "features_v2", "cross_texts", "encode_target_strict", "ratio_amount_per_line"]
NO_MODEL = sorted(n for n, f in QUERIES.items() if f.__module__ != "propensity.catalog.models")


@pytest.mark.parametrize("name", NO_MODEL)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(QUERIES[name](spark, folder), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, bad


def test_scan_reads_only_the_needed_columns(spark, folder):
    text = plan(QUERIES["target_rate_region"](spark, folder))
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(set(r.split(",")) == {"o_custkey:bigint", "o_orderstatus:string"} for r in reads)
    assert "lineitem" not in text


def test_filters_reach_the_scan(spark, folder):
    df = frames.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan(df)


def test_one_scan_per_family(spark, folder):
    cols = ["priority", "urgency", "split", "target"]
    df = frames.orders_frame(spark, folder, [*cols, "y"])
    for made in (rates.triple_interactions(df, cols, "y", 1), rates.combo_frequencies(df, cols)):
        made.collect()
        text = plan(made, "simple").split("\n+- == Initial Plan ==")[0]
        # All subsets expand from one grouped scan.
        assert text.count("FileScan") == 1 and text.count("Generate explode") == 1


def test_overall_rate_reuses_the_groups(spark, folder):
    df = frames.orders_frame(spark, folder, ["priority", "urgency", "split", "y"])
    made = rates.pair_interactions(df, ["priority", "urgency", "split"], "y", 1)
    made.collect()
    assert "ReusedExchange" in plan(made, "simple")


def test_average_precision_groups_the_scores_once(spark, folder, tiny_tasks):
    made = metrics.average_precision(frames.orders_frame(spark, folder, ["y", "score_a"]), "y", "score_a")
    made.collect()
    assert "ReusedExchange" in plan(made, "simple")


@pytest.mark.parametrize("make", [
    lambda df: metrics.roc_auc(df, "y", "score_a"),
    lambda df: metrics.grouped_auc(df, ["priority"], "y", "score_a"),
    lambda df: metrics.average_precision(df, "y", "score_a"),
    lambda df: order.percentile_rank(df, "score_a", "id"),
    lambda df: folds.stratified_folds(df, "id", "y"),
])
def test_windows_over_rows_are_partitioned(spark, folder, tiny_tasks, make):
    df = frames.orders_frame(spark, folder, ["id", "priority", "y", "score_a"])
    text = plan(make(df))
    for window in re.findall(r"\) Window\n(.*?)\n\n", text, re.S):
        if "_bucket" not in window:
            continue
        # Only the small table of bucket totals may be ordered as a whole.
        whole = re.search(r"Arguments: .*\], \[\], ", window)
        assert not whole or "ORDER BY" in window


def test_sampling_does_not_shuffle_the_rows(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y"])
    text = plan(folds.stratified_holdout(df, "id", "y"), "simple")
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_top_k_is_not_a_full_sort(spark, folder):
    text = plan(order.top_k(frames.orders_frame(spark, folder, ["id", "score_a"]), "score_a", 5, "id"), "simple")
    assert "TakeOrderedAndProject" in text


def test_bins_are_plain_expressions(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "amount"])
    text = plan(order.quantile_bin(df, "amount", 10), "simple")
    assert "Exchange" not in text and "Window" not in text
    assert df.where(F.col("amount").isNull()).count() == 0
