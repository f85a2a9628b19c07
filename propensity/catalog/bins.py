"""Bins, ranks, running totals, sorts and top-k."""

from pyspark.sql import functions as F

from propensity.catalog.registry import P, bin_sql, edges_sql, flat, query, rounded, with_p
from propensity.operators import features, order
from propensity.sources import frames


def _bin_query(src: str, col: str, q: int) -> str:
    return f"""
      SELECT id, bin, round(e[bin + 1], 5) AS lo, round(e[bin + 2], 5) AS hi
      FROM (SELECT id, e, {bin_sql('e', col)} AS bin
            FROM (SELECT id, {col}, {edges_sql(src, col, q)} AS e FROM {src}) a) b"""


@query(with_p(_bin_query("p", "amount", 10)))
def quantile_bin_amount(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "amount"])
    binned = order.quantile_bin(df, "amount", 10, "b")
    return rounded(binned.select("id", "b.*"), 5)


@query(with_p(_bin_query("p", "n_lines", 5)))
def quantile_bin_tied_lines(spark, folder):
    df = flat(spark, folder, ["id", "n_lines"])
    binned = order.quantile_bin(df, "n_lines", 5, "b")
    return rounded(binned.select("id", "b.*"), 5)


def _rank_sql(col: str, src: str) -> str:
    return (f"SELECT id, round((rank() OVER (ORDER BY {col}) + CAST(count(*) OVER (PARTITION BY {col}) - 1 AS DOUBLE)"
            f" / 2) / count(*) OVER (), 6) AS pct_rank FROM {src}")


@query(with_p(_rank_sql("score_b", "p")))
def percentile_rank_score(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "score_b"])
    return rounded(order.percentile_rank(df, "score_b", "id").select("id", "pct_rank"))


@query(_rank_sql("value", "(SELECT event_id AS id, value FROM events)"))
def percentile_rank_event_value(spark, folder):
    df = frames.events_frame(spark, folder).select("id", "value")
    return rounded(order.percentile_rank(df, "value", "id").select("id", "pct_rank"))


@query(with_p("""
  SELECT score_a, n, positives, CAST(sum(n) OVER (ORDER BY score_a) AS BIGINT) AS cum_n,
         CAST(sum(positives) OVER (ORDER BY score_a) AS BIGINT) AS cum_positives
  FROM (SELECT score_a, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM p GROUP BY 1) g"""))
def running_totals_by_score(spark, folder):
    df = frames.orders_frame(spark, folder, ["score_a", "y"])
    ones = df.select("score_a", F.lit(1).alias("n"), F.col("y").cast("long").alias("positives"))
    return order.ordered_cumsum(ones, "score_a", ["n", "positives"])


@query(with_p(f"""
  SELECT bin, count(*) AS count, avg(y) AS actual_rate, sum(score_d) / count(*) AS mean_prediction,
         min(score_d) AS min_prediction, max(score_d) AS max_prediction, avg(y) * 100 AS actual_rate_pct
  FROM (SELECT y, score_d, {bin_sql('e', 'score_d')} AS bin
        FROM (SELECT y, score_d, {edges_sql('p', 'score_d', 10)} AS e FROM p) a) b GROUP BY bin"""))
def decile_table(spark, folder):
    df = frames.orders_frame(spark, folder, ["score_d", "y"])
    return order.decile_table(df, "score_d", "y", 10)


@query(with_p("""SELECT id, target, y, score_a, round(y - score_a, 6) AS residual, round(abs(y - score_a), 6) AS abs_residual
                 FROM p ORDER BY abs(y - score_a) DESC, id LIMIT 50"""))
def top_residuals(spark, folder):
    df = features.residuals(frames.orders_frame(spark, folder, ["id", "target", "y", "score_a"]), "y", "score_a")
    return rounded(order.top_k(df, "abs_residual", 50, "id"))


@query(with_p("SELECT id, y, score_a, amount, rich, urgency FROM p WHERE y = 1 ORDER BY score_a, id LIMIT 100"))
def hard_positives(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y", "score_a", "amount", "rich", "urgency"])
    return order.top_k(df, "score_a", 100, "id", ascending=True, where=F.col("y") == 1)


@query(with_p("SELECT id, y, score_a, amount, rich, urgency FROM p WHERE y = 0 ORDER BY score_a DESC, id LIMIT 100"))
def hard_negatives(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y", "score_a", "amount", "rich", "urgency"])
    return order.top_k(df, "score_a", 100, "id", where=F.col("y") == 0)


@query(f"SELECT id, amount FROM ({P}) ORDER BY amount DESC, id")
def sorted_by_amount(spark, folder):
    return order.sort_rows(frames.orders_frame(spark, folder, ["id", "amount"]), "amount", "id")
