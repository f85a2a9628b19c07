"""Keyed joins, set operations and blends."""

from pyspark.sql import functions as F

from propensity.catalog.registry import P, flat, query, rounded, with_p
from propensity.operators import align, ensemble, order, profile
from propensity.sources import frames


@query(with_p("SELECT id, amount, y, score_a FROM p"))
def attach_predictions(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "amount", "y"])
    return align.attach(df, frames.orders_frame(spark, folder, ["id", "y", "score_a"]).drop("y"), "id")


def _models(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "y", "score_a", "score_b"])
    return align.align_models({m: df.select("id", F.col(f"score_{m}").alias("prediction")) for m in ("a", "b")}, "id")


@query(with_p("SELECT id, score_a AS a, score_b AS b FROM p"))
def align_two_models(spark, folder):
    return _models(spark, folder)


@query(with_p("SELECT id, round(0.935 * score_a + 0.065 * score_b, 6) AS blend FROM p"))
def blend_of_probabilities(spark, folder):
    weights = dict(zip(("a", "b"), ensemble.PROBABILITY_WEIGHTS))
    return rounded(ensemble.blend_probability(_models(spark, folder), weights).select("id", "blend"))


def _rank_sql(col: str) -> str:
    return (f"(rank() OVER (ORDER BY {col}) + CAST(count(*) OVER (PARTITION BY {col}) - 1 AS DOUBLE) / 2)"
            " / count(*) OVER ()")


@query(with_p(f"SELECT id, round(0.928 * ({_rank_sql('score_a')}) + 0.072 * ({_rank_sql('score_b')}), 6) AS blend FROM p"))
def blend_of_ranks(spark, folder):
    weights = dict(zip(("a", "b"), ensemble.RANK_WEIGHTS))
    blend = ensemble.blend_rank(_models(spark, folder), weights, "id")
    return rounded(blend.select("id", "blend"))


@query(with_p("SELECT id FROM p WHERE split = 'train' AND priority = '1-URGENT'"))
def id_overlap(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "split", "priority"])
    return align.id_overlap(df.where("split = 'train'"), df.where("priority = '1-URGENT'"), "id")


@query("""
  SELECT o_orderkey AS id, 'left' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL
  SELECT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def id_mismatch(spark, folder):
    left = frames.table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    right = frames.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return align.id_mismatch(left, right, "id")


@query(f"""
  WITH p AS ({P}),
  hp AS (SELECT * FROM p WHERE y = 1 ORDER BY score_a, id LIMIT 100),
  hn AS (SELECT * FROM p WHERE y = 0 ORDER BY score_a DESC, id LIMIT 100),
  a AS (SELECT region, count(*) / 100.0 AS s FROM hp GROUP BY 1),
  b AS (SELECT region, count(*) / 100.0 AS s FROM hn GROUP BY 1)
  SELECT coalesce(a.region, b.region) AS region, CAST(coalesce(a.s, 0) AS DOUBLE) AS hard_positive,
         CAST(coalesce(b.s, 0) AS DOUBLE) AS hard_negative
  FROM a FULL OUTER JOIN b ON a.region = b.region""")
def compare_hard_case_shares(spark, folder):
    df = flat(spark, folder, ["id", "y", "score_a", "region"])
    hard = order.top_k(df, "score_a", 100, "id", ascending=True, where=F.col("y") == 1)
    easy = order.top_k(df, "score_a", 100, "id", where=F.col("y") == 0)
    return align.compare_shares(hard, easy, "region", ("hard_positive", "hard_negative"))


@query(with_p("SELECT id, region FROM p WHERE split = 'train' UNION ALL SELECT id, region FROM p WHERE split = 'test'"))
def stack_splits(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "split", "region"])
    train, test = (df.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    return align.stack_rows(train, test.select("region", "id"))


@query("SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL")
def distinct_event_types(spark, folder):
    return profile.distinct_levels(frames.table(spark, folder, "events"), "event_type")
