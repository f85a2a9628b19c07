"""Integrity and distribution reports."""

from pyspark.sql import functions as F

from propensity.catalog.registry import P, flat, query, rounded, with_p
from propensity.functions import columns as fx
from propensity.operators import order, profile
from propensity.sources import frames

NUM = frames.NUMBERS


@query("""
  SELECT position, "column", type, (SELECT count(*) FROM customer) AS rows, CAST(5 AS INTEGER) AS columns
  FROM (VALUES (CAST(0 AS INTEGER), 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
               (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) t(position, "column", type)""")
def shape_and_types(spark, folder):
    return profile.shape_types(frames.table(spark, folder, "customer"))


@query(with_p("""
  SELECT "column", CAST(missing AS BIGINT) AS missing FROM (
    SELECT 'id' AS "column", 0 AS missing
    UNION ALL SELECT 'segment', count(*) FILTER (WHERE segment = 'BUILDING') FROM p
    UNION ALL SELECT 'amount', count(*) FILTER (WHERE n_lines = 0) FROM p
    UNION ALL SELECT '(total)', count(*) FILTER (WHERE segment = 'BUILDING') + count(*) FILTER (WHERE n_lines = 0)
              FROM p) t"""))
def missing_counts(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "segment", "amount", "n_lines"])
    gaps = df.select("id", F.nullif(F.col("segment"), F.lit("BUILDING")).alias("segment"),
                     F.when(F.col("n_lines") > 0, F.col("amount")).otherwise(float("nan")).alias("amount"))
    return profile.missing_counts(gaps)


@query("SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS distinct, "
       "count(*) = count(DISTINCT l_orderkey) AS unique FROM lineitem".replace("distinct,", '"distinct",')
       .replace("AS unique", 'AS "unique"'))
def key_uniqueness(spark, folder):
    return profile.is_unique(frames.table(spark, folder, "lineitem"), "l_orderkey")


@query("SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text) t")
def duplicate_documents(spark, folder):
    return profile.duplicate_rows(frames.table(spark, folder, "documents").select("text"), digest=["text"])


@query("""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) t""")
def duplicate_lines(spark, folder):
    lines = frames.table(spark, folder, "lineitem")
    return profile.duplicate_rows(lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                               "l_returnflag", "l_linestatus"), exclude=["l_orderkey"])


@query("SELECT event_type, count(*) AS count, round(count(*) / (SELECT count(*) FROM events), 6) AS share "
       "FROM events GROUP BY 1")
def value_counts_event_type(spark, folder):
    return rounded(profile.value_counts(frames.table(spark, folder, "events"), "event_type"))


@query("SELECT user_id, count(*) AS count, round(count(*) / (SELECT count(*) FROM events), 6) AS share "
       "FROM events GROUP BY 1")
def value_counts_user(spark, folder):
    return rounded(profile.value_counts(frames.table(spark, folder, "events"), "user_id"))


@query("""
  SELECT 'l_suppkey' AS "column", count(DISTINCT l_suppkey) AS "distinct" FROM lineitem
  UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem
  UNION ALL SELECT 'l_quantity', count(DISTINCT l_quantity) FROM lineitem""")
def distinct_counts(spark, folder):
    return profile.distinct_count(frames.table(spark, folder, "lineitem"), ["l_suppkey", "l_returnflag", "l_quantity"])


def describe_sql(col: str, src: str) -> str:
    q = [f"round(quantile_cont(CAST({col} AS DOUBLE), {v}), 4) AS q{int(v * 100)}" for v in (0.25, 0.5, 0.75)]
    return (f"SELECT '{col}' AS \"column\", count({col}) AS count, round(avg({col}), 4) AS mean, "
            f"round(stddev_samp({col}), 4) AS std, round(CAST(min({col}) AS DOUBLE), 4) AS min, {', '.join(q)}, "
            f"round(CAST(max({col}) AS DOUBLE), 4) AS max FROM {src}")


@query(with_p(" UNION ALL ".join(describe_sql(c, "p") for c in NUM)))
def describe_orders(spark, folder):
    df = frames.orders_frame(spark, folder, NUM)
    return rounded(profile.describe(df, NUM), 4)


@query(describe_sql("value", "events"))
def describe_events(spark, folder):
    return rounded(profile.describe(frames.table(spark, folder, "events"), ["value"]), 4)


def _levels_sql(col: str) -> str:
    return f"""
      SELECT '{col}' AS "column", count(*) AS levels, count(*) FILTER (WHERE b IS NULL) AS train_only,
             count(*) FILTER (WHERE a IS NULL) AS test_only, bool_and(a IS NOT NULL AND b IS NOT NULL) AS same
      FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS a FROM p WHERE split = 'train') x
      FULL OUTER JOIN (SELECT DISTINCT CAST({col} AS VARCHAR) AS b FROM p WHERE split = 'test') y ON a = b"""


@query(with_p(" UNION ALL ".join(_levels_sql(c) for c in ("region", "segment", "qty"))))
def level_consistency(spark, folder):
    df = flat(spark, folder, ["split", "region", "segment", "qty"])
    return profile.level_consistency(df.where("split = 'train'"), df.where("split = 'test'"),
                                     ["region", "segment", "qty"])


@query(with_p("""
  SELECT priority, count(*) FILTER (WHERE target = 'No') AS "n_No", count(*) FILTER (WHERE target = 'Yes') AS "n_Yes",
         round(100.0 * count(*) FILTER (WHERE target = 'No') / count(*), 6) AS "pct_No",
         round(100.0 * count(*) FILTER (WHERE target = 'Yes') / count(*), 6) AS "pct_Yes"
  FROM p GROUP BY 1"""))
def crosstab_priority(spark, folder):
    df = frames.orders_frame(spark, folder, ["priority", "target"])
    return rounded(profile.crosstab_share(df, "priority", "target", ["No", "Yes"]))


@query(with_p(" UNION ALL ".join(f"""
  SELECT '{c}' AS feature, {c} AS value, count(*) FILTER (WHERE target = 'No') AS "n_No",
         count(*) FILTER (WHERE target = 'Yes') AS "n_Yes",
         round(100.0 * count(*) FILTER (WHERE target = 'No') / count(*), 6) AS "pct_No",
         round(100.0 * count(*) FILTER (WHERE target = 'Yes') / count(*), 6) AS "pct_Yes"
  FROM p GROUP BY {c}""" for c in frames.CATEGORIES)))
def crosstabs_all(spark, folder):
    df = frames.orders_frame(spark, folder, [*frames.CATEGORIES, "target"])
    return rounded(profile.crosstab_shares(df, frames.CATEGORIES, "target", ["No", "Yes"]))


def _class_mean_sql(col: str) -> str:
    return (f"SELECT '{col}' AS \"column\", avg({col}) FILTER (WHERE target = 'No') AS a, "
            f"avg({col}) FILTER (WHERE target = 'Yes') AS b FROM p")


@query(with_p(f"""
  SELECT "column", round(a, 5) AS no_mean, round(b, 5) AS yes_mean, round((b - a) / a * 100, 2) AS diff_pct
  FROM ({" UNION ALL ".join(_class_mean_sql(c) for c in NUM)}) t"""))
def class_means(spark, folder):
    return rounded(profile.class_means(frames.orders_frame(spark, folder, [*NUM, "target"]), NUM, "target"), 5)


_HARD = f"""
  WITH p AS ({P}),
  hp AS (SELECT * FROM p WHERE y = 1 ORDER BY score_a, id LIMIT 100),
  hn AS (SELECT * FROM p WHERE y = 0 ORDER BY score_a DESC, id LIMIT 100)"""


@query(_HARD + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", round((SELECT avg({c}) FROM hp), 5) AS hard_positive_mean,
         round((SELECT avg({c}) FROM hn), 5) AS hard_negative_mean""" for c in NUM))
def hard_case_means(spark, folder):
    df = flat(spark, folder, ["id", "y", "score_a", *NUM])
    hard = order.top_k(df, "score_a", 100, "id", ascending=True, where=F.col("y") == 1)
    easy = order.top_k(df, "score_a", 100, "id", where=F.col("y") == 0)
    return rounded(profile.group_means(hard, easy, NUM, ("hard_positive", "hard_negative")), 5)


def _histogram_sql(src: str, col: str, bins: int, by: str) -> str:
    return f"""
      SELECT {by}, bin, round(any_value(lo) + any_value(w) * bin, 5) AS lo,
             round(any_value(lo) + any_value(w) * (bin + 1), 5) AS hi, count(*) AS count,
             round(count(*) / any_value(n) / any_value(w), 8) AS density
      FROM (SELECT {by}, lo, w, n, CAST(least(floor(({col} - lo) / w), {bins - 1}) AS INTEGER) AS bin
            FROM (SELECT {by}, {col}, min({col}) OVER g AS lo,
                         (max({col}) OVER g - min({col}) OVER g) / CAST({bins} AS DOUBLE) AS w,
                         CAST(count(*) OVER g AS DOUBLE) AS n
                  FROM {src} WINDOW g AS (PARTITION BY {by})) a) b
      GROUP BY {by}, bin"""


@query(with_p(_histogram_sql("p", "amount", 100, "y")))
def histogram_amount_by_class(spark, folder):
    df = frames.orders_frame(spark, folder, ["amount", "y"])
    return rounded(profile.histogram(df, "amount", 100, "y"), 5, density=8)


@query(_histogram_sql("(SELECT *, 0 AS one FROM events)", "value", 20, "one")
       .replace("SELECT one, bin, round", "SELECT bin, round", 1))
def histogram_event_value(spark, folder):
    return rounded(profile.histogram(frames.table(spark, folder, "events"), "value", 20), 5, density=8)


@query(with_p(" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM p" for a in NUM for b in NUM)))
def corr_matrix(spark, folder):
    return rounded(profile.corr_matrix(frames.orders_frame(spark, folder, NUM), NUM))


@query(with_p("SELECT a, " + ", ".join(
    f"round(max(CASE WHEN b = '{c}' THEN r END), 3) + 0.0 AS {c}" for c in NUM) + " FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM p" for a in NUM for b in NUM) + ") t GROUP BY a"))
def corr_square(spark, folder):
    df = frames.orders_frame(spark, folder, NUM)
    return rounded(profile.corr_wide(profile.corr_matrix(df, NUM), NUM), 3)


_CANDIDATES = {
    "amount_per_nation": "amount / (nation + 1)", "amount_per_line": "amount / (n_lines + 1)",
    "lines_total": "n_lines + n_supp", "lines_difference": "n_supp - n_lines",
    "supp_per_qty": "n_supp / (qty + 1)", "lines_per_qty": "n_lines / (qty + 1)",
}


@query(with_p(" UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(corr(CAST({e} AS DOUBLE), y), 6) + 0.0 AS corr FROM p"
    for n, e in _CANDIDATES.items())))
def corr_of_candidates(spark, folder):
    df = frames.orders_frame(spark, folder, [*NUM, "y"])
    made = {
        "amount_per_nation": fx.ratio("amount", "nation", offset=1),
        "amount_per_line": fx.ratio("amount", "n_lines", offset=1),
        "lines_total": fx.row_sum("n_lines", "n_supp"),
        "lines_difference": fx.row_diff("n_supp", "n_lines"),
        "supp_per_qty": fx.ratio("n_supp", "qty", offset=1),
        "lines_per_qty": fx.ratio("n_lines", "qty", offset=1),
    }
    return rounded(profile.corr_with_target(df, made, "y"))


@query(with_p("""
  SELECT min(score_d) AS min, max(score_d) AS max, sum(score_d) / count(*) AS mean,
         quantile_cont(score_d, 0.5) AS median, round(stddev_pop(score_d), 6) AS std FROM p"""))
def prediction_stats(spark, folder):
    df = frames.orders_frame(spark, folder, ["score_d"])
    stats = profile.prediction_stats(df, "score_d")
    return rounded(stats, exact=["min", "max", "mean", "median"])
