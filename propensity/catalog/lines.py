"""The rate, quantile and AUC families over order lines, the largest table."""

from itertools import combinations

from propensity.catalog.profiling import describe_sql
from propensity.catalog.rates import RANGE_SQL, profile_sql, spread_sql
from propensity.catalog.registry import auc_sql, bin_sql, edges_sql, query, rounded
from propensity.operators import metrics, profile, rates
from propensity.sources import frames

CATS, NUMS, MODS = frames.LINE_CATEGORIES, frames.LINE_NUMBERS, (2, 3, 5, 10, 100)
T = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity AS quantity, l_extendedprice AS price,
              l_linenumber AS line, l_linestatus AS status, CAST(round(l_discount * 100) AS BIGINT) AS discount,
              CAST(round(l_tax * 100) AS BIGINT) AS tax FROM lineitem"""


def _with(body: str) -> str:
    return f"WITH t AS ({T}) {body}"


@query(_with(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, avg(y) AS mean, count(*) AS count,
               CAST(sum(y) AS BIGINT) AS positives, avg(y) * 100 AS rate_pct FROM t GROUP BY {c}""" for c in CATS)))
def line_target_rates(spark, folder):
    return rates.target_rates(frames.lines_frame(spark, folder), CATS, "y")


@query(_with(" UNION ALL ".join(spread_sql(
    f"'{a}' AS feature_1, '{b}' AS feature_2, count(*) AS n_combinations", [a, b], "t",
    f"{RANGE_SQL}, round(sum(abs(rate - (SELECT avg(y) FROM t)) * n) / sum(n), 6) AS weighted_std")
    for a, b in combinations(CATS, 2))))
def line_pair_interactions(spark, folder):
    return rounded(rates.pair_interactions(frames.lines_frame(spark, folder), CATS, "y", 100))


@query(_with(" UNION ALL ".join(spread_sql(
    f"'{' × '.join(c)}' AS features, count(*) AS n_groups", list(c), "t", RANGE_SQL, 20) for c in combinations(CATS, 3))))
def line_triple_interactions(spark, folder):
    return rounded(rates.triple_interactions(frames.lines_frame(spark, folder), CATS, "y", 20))


@query(_with(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", * FROM ({profile_sql('t', c, 10)}) x" for c in NUMS)))
def line_numeric_profiles(spark, folder):
    df = frames.lines_frame(spark, folder)
    return rounded(rates.numeric_profiles(df, NUMS, "y", 10), lo=5, hi=5)


_BINNED = ", ".join(f"{bin_sql('e_' + c, c)} AS {c}_bin" for c in NUMS)
_EDGES = ", ".join(f"{edges_sql('t', c, 5)} AS e_{c}" for c in NUMS)


@query(f"WITH t AS ({T}), b AS (SELECT *, {_BINNED} FROM (SELECT t.*, {_EDGES} FROM t) a) " + " UNION ALL ".join(
    spread_sql(f"'{n}' AS numerical, '{c}' AS categorical", [f"{n}_bin", c], "b", RANGE_SQL)
    for n in NUMS for c in CATS))
def line_numeric_cat_interactions(spark, folder):
    df = frames.lines_frame(spark, folder)
    return rounded(rates.numeric_cat_interactions(df, NUMS, CATS, "y", 5, 100))


@query(_with(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, 'mod_{m}' AS operation, max(abs(rate - (SELECT avg(y) FROM t))) AS max_deviation,
               CAST(sum(pos) AS DOUBLE) / sum(n) AS weighted_rate, count(*) AS n_groups
        FROM (SELECT CAST({c} AS DOUBLE) % {m} AS v, avg(y) AS rate, sum(y) AS pos, count(*) AS n FROM t
              GROUP BY 1 HAVING count(*) >= 30) g HAVING count(*) > 0""" for c in ("quantity", "line") for m in MODS)))
def line_modulo_audit(spark, folder):
    return rates.modulo_audit(frames.lines_frame(spark, folder), ["quantity", "line"], MODS, "y", 30)


@query(f"WITH t AS ({T}), s AS (SELECT y, price AS s FROM t) "
       f"SELECT n, positives, round(auc, 6) AS auc FROM ({auc_sql('s')}) x")
def line_roc_auc(spark, folder):
    return rounded(metrics.roc_auc(frames.lines_frame(spark, folder), "y", "price"))


@query(f"WITH t AS ({T}), s AS (SELECT *, quantity AS s FROM t) "
       f"SELECT status, line, n, positives / n AS positive_rate, round(auc, 6) AS auc "
       f"FROM ({auc_sql('s', ['status', 'line'])}) x")
def line_grouped_auc(spark, folder):
    df = frames.lines_frame(spark, folder)
    return rounded(metrics.grouped_auc(df, ["status", "line"], "y", "quantity"),
                   exact=["positive_rate"])


@query(_with(" UNION ALL ".join(describe_sql(c, "t") for c in ("quantity", "line", "discount", "tax"))))
def line_describe(spark, folder):
    df = frames.lines_frame(spark, folder)
    return rounded(profile.describe(df, ["quantity", "line", "discount", "tax"]), 4)
