"""ROC-AUC, average precision and tables of them."""

from propensity.catalog.registry import (
    L,
    P,
    ap_sql,
    auc_sql,
    bin_sql,
    edges_sql,
    flat,
    query,
    rounded,
    with_p,
)
from propensity.operators import metrics
from propensity.operators.folds import stratified_folds
from propensity.sources import frames

S = f"WITH p AS ({P}), s AS (SELECT *, score_a AS s FROM p)"


@query(f"{S} SELECT n, positives, round(auc, 6) AS auc FROM ({auc_sql('s')}) t")
def roc_auc(spark, folder):
    df = frames.orders_frame(spark, folder, ["y", "score_a"])
    return rounded(metrics.roc_auc(df, "y", "score_a"))


@query(f"{S} SELECT round(average_precision, 6) AS average_precision FROM ({ap_sql('s')}) t")
def average_precision(spark, folder):
    df = frames.orders_frame(spark, folder, ["y", "score_a"])
    return rounded(metrics.average_precision(df, "y", "score_a"))


def _group_sql(src: str, by: list[str], where: str = "true") -> str:
    return (f"SELECT {', '.join(by)}, n, round(positives / n, 6) AS positive_rate, round(auc, 6) AS auc "
            f"FROM ({auc_sql(src, by)}) t WHERE {where}")


@query(f"{S} {_group_sql('s', ['region'])}")
def grouped_auc_region(spark, folder):
    df = frames.orders_frame(spark, folder, ["region", "y", "score_a"])
    return rounded(metrics.grouped_auc(df, ["region"], "y", "score_a"))


@query(f"WITH s AS (SELECT *, CAST(n_chars AS DOUBLE) AS s, toxic AS y FROM ({L})) {_group_sql('s', ['source'])}")
def grouped_auc_source(spark, folder):
    """Few rows per source, so some sources have one class and a null AUC."""
    return rounded(metrics.grouped_auc(frames.documents_frame(spark, folder), ["source"], "toxic", "n_chars"))


_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, y, s FROM s" for c in frames.CATEGORIES)


@query(f"{S}, u AS ({_LONG}) {_group_sql('u', ['feature', 'value'])}")
def subgroup_auc(spark, folder):
    df = frames.orders_frame(spark, folder, [*frames.CATEGORIES, "y", "score_a"])
    return rounded(metrics.subgroup_auc(df, frames.CATEGORIES, "y", "score_a"))


_AMOUNT_BIN = f"b AS (SELECT *, {bin_sql('e', 'amount')} AS bin FROM (SELECT s.*, {edges_sql('s', 'amount', 10)} AS e FROM s) a)"


@query(f"""{S.replace('score_a AS s', 'score_d AS s')}, {_AMOUNT_BIN}
  SELECT t.bin, round(m.lo, 5) AS lo, round(m.hi, 5) AS hi, n, positives / n AS positive_rate,
         round(auc, 6) AS auc, m.mp AS mean_prediction
  FROM ({auc_sql('b', ['bin'])}) t
  JOIN (SELECT bin, any_value(e[bin + 1]) AS lo, any_value(e[bin + 2]) AS hi, sum(s) / count(*) AS mp
        FROM b GROUP BY bin) m
    ON t.bin = m.bin""")
def auc_by_quantile(spark, folder):
    df = frames.orders_frame(spark, folder, ["amount", "y", "score_d"])
    out = metrics.auc_by_quantile(df, "amount", "y", "score_d", 10)
    return rounded(out, exact=["positive_rate", "mean_prediction"], lo=5, hi=5)


_MIXED = (f"b AS (SELECT *, {bin_sql('ea', 'amount')} AS amount_bin, {bin_sql('eb', 'n_lines')} AS n_lines_bin FROM "
          f"(SELECT s.*, {edges_sql('s', 'amount', 10)} AS ea, {edges_sql('s', 'n_lines', 5)} AS eb FROM s) a)")
_MIN = 50


@query(f"{S} {_group_sql('s', ['rich', 'n_lines'], f'n >= {_MIN} AND auc IS NOT NULL')}")
def conditional_auc_two_keys(spark, folder):
    df = flat(spark, folder, ["rich", "n_lines", "y", "score_a"])
    return rounded(metrics.conditional_auc(df, "y", "score_a", ["rich", "n_lines"], min_count=_MIN))


@query(f"{S}, {_MIXED} {_group_sql('b', ['rich', 'amount_bin', 'n_lines_bin'], f'n >= {_MIN} AND auc IS NOT NULL')}")
def conditional_auc_mixed(spark, folder):
    df = flat(spark, folder, ["rich", "amount", "n_lines", "y", "score_a"])
    return rounded(metrics.conditional_auc(df, "y", "score_a", ["rich"], {"amount": 10, "n_lines": 5}, _MIN))


_FOLDED = ("f AS (SELECT *, CAST((row_number() OVER (ORDER BY y, md5('42:' || id), id) - 1) % 5 AS INTEGER) AS fold "
           "FROM s)")


def _folded(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y", "score_a"])
    return stratified_folds(df, "id", "y", 5, 42)


@query(f"{S}, {_FOLDED} {_group_sql('f', ['fold'])}")
def fold_auc(spark, folder):
    return rounded(metrics.fold_auc(_folded(spark, folder), "y", "score_a", "fold"))


@query(f"""{S}, {_FOLDED}, g AS ({auc_sql('f', ['fold'])}), a AS ({auc_sql('s')})
  SELECT count(*) AS folds, round(avg(g.auc), 6) AS mean_auc, round(stddev_pop(g.auc), 6) AS std_auc,
         round(any_value(a.auc), 6) AS pooled_auc FROM g, a""")
def pooled_vs_fold(spark, folder):
    return rounded(metrics.pooled_vs_fold(_folded(spark, folder), "y", "score_a", "fold"))


_LEVELS = (0.1, 0.175, 0.3, 0.5)


@query(with_p(" UNION ALL ".join(
    f"""SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE score_a >= {t} AND y = 1) AS tp,
               count(*) FILTER (WHERE score_a >= {t} AND y = 0) AS fp, count(*) FILTER (WHERE score_a < {t} AND y = 0) AS tn,
               count(*) FILTER (WHERE score_a < {t} AND y = 1) AS fn FROM p""" for t in _LEVELS)))
def confusion_at_thresholds(spark, folder):
    return metrics.confusion_at(frames.orders_frame(spark, folder, ["y", "score_a"]), "y", "score_a", _LEVELS)


@query(with_p("SELECT round(avg(y), 6) AS base_rate, CAST(0.5 AS DOUBLE) AS auc, round(avg(y), 6) AS average_precision FROM p"))
def constant_baseline(spark, folder):
    return rounded(metrics.constant_baseline(frames.orders_frame(spark, folder, ["y"]), "y"))
