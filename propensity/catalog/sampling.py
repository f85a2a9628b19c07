"""Folds, holdouts and samples."""

from propensity.catalog.registry import P, query, rounded, with_p
from propensity.operators import folds
from propensity.sources import frames

_PLACE = "row_number() OVER (ORDER BY y, md5('42:' || id), id) - 1"
_IN_CLASS = "row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id), id)"
_SIZE = "count(*) OVER (PARTITION BY y)"


def _orders(spark, folder):
    return frames.orders_frame(spark, folder, ["id", "y"])


@query(with_p(f"SELECT id, y, CAST(({_PLACE}) % 5 AS INTEGER) AS fold FROM p"))
def stratified_folds(spark, folder):
    return folds.stratified_folds(_orders(spark, folder), "id", "y", 5, 42)


@query(with_p(f"""SELECT fold, count(*) AS rows, round(avg(y), 6) AS positive_rate
                  FROM (SELECT y, CAST(({_PLACE}) % 5 AS INTEGER) AS fold FROM p) t GROUP BY 1"""))
def fold_audit(spark, folder):
    return rounded(folds.fold_audit(stratified_folds(spark, folder), "fold", "y"))


@query(with_p(f"SELECT id, y, {_IN_CLASS} <= floor({_SIZE} / CAST(5 AS DOUBLE) + 0.5) AS holdout FROM p"))
def stratified_holdout(spark, folder):
    return folds.stratified_holdout(_orders(spark, folder), "id", "y", 0.2, 42)


@query(f"""SELECT id, y FROM (SELECT id, y, {_IN_CLASS} AS r, {_SIZE} AS n FROM ({P}) p) t
           WHERE r <= least(n, greatest(120, n // 50))""")
def stratified_sample(spark, folder):
    return folds.stratified_sample(_orders(spark, folder), "id", "y", 0.02, 120, 42)


@query(f"""SELECT id, y FROM (SELECT id, y, row_number() OVER (ORDER BY md5('7:' || id), id) AS r,
                                     count(*) OVER () AS n FROM ({P}) p) t
           WHERE r <= floor(n / CAST(20 AS DOUBLE) + 0.5)""")
def sample_fraction(spark, folder):
    return folds.sample_fraction(_orders(spark, folder), "id", 0.05, 7)
