"""Scans, sinks, target encoding and validators."""

from pyspark.sql import functions as F

from propensity.catalog.registry import E, P, query, rounded, with_p
from propensity.operators import align, checks
from propensity.session import work_folder
from propensity.sources import contract, files, frames, ledger


@query(with_p("SELECT id, split, amount, balance, n_lines, region, rich, target FROM p"))
def csv_round_trip(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "split", "amount", "balance", "n_lines", "region", "rich", "target"])
    path = work_folder(spark, "csv")
    files.write_scored(df, path, "id")
    return files.scan_csv(spark, path, contract.contract_of(df, "id", "target"))


@query(with_p("SELECT id, CASE target WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS target FROM p"))
def encode_target_strict(spark, folder):
    return checks.encode_target(frames.orders_frame(spark, folder, ["id", "target"]), "target")


@query(f"SELECT id, CASE WHEN id % 4 IN (0, 2) THEN 1 ELSE 0 END AS label FROM ({E})")
def encode_target_lenient(spark, folder):
    df = frames.events_frame(spark, folder).select("id", "label_text")
    return checks.encode_target(df, "label_text", strict=False, out="label").select("id", "label")


@query("SELECT o_orderpriority, count(*) AS count FROM orders "
       "WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def bad_target_values(spark, folder):
    return checks.bad_targets(frames.table(spark, folder, "orders"), "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 0})


@query(with_p("SELECT id, CAST(qty AS BIGINT) AS qty FROM p"))
def coerce_whole_numbers(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "qty"]).withColumn("qty", F.col("qty").cast("double"))
    return checks.coerce_integral(df, ["qty"])


@query(with_p("""
  SELECT rule, CAST(bad AS BIGINT) AS bad, bad = 0 AS ok FROM (
    SELECT 'empty' AS rule, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bad FROM p
    UNION ALL SELECT 'null_key', count(*) - count(id) FROM p
    UNION ALL SELECT 'repeated_key', count(id) - count(DISTINCT id) FROM p)"""))
def validate_raw_orders(spark, folder):
    return checks.validate_raw(frames.orders_frame(spark, folder, ["id", "target", "rich"]), "id", "target")


@query("""
  SELECT rule, CAST(bad AS BIGINT) AS bad, bad = 0 AS ok FROM (
    SELECT 'empty' AS rule, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bad FROM lineitem
    UNION ALL SELECT 'null_key', count(*) - count(l_orderkey) FROM lineitem
    UNION ALL SELECT 'repeated_key', count(l_orderkey) - count(DISTINCT l_orderkey) FROM lineitem)""")
def validate_raw_lineitem(spark, folder):
    return checks.validate_raw(frames.table(spark, folder, "lineitem"), "l_orderkey")


@query(with_p("""
  SELECT 'not_finite' AS rule, CAST(0 AS BIGINT) AS bad, true AS ok
  UNION ALL SELECT 'not_binary', bad, bad = 0
  FROM (SELECT count(*) AS bad FROM p WHERE n_lines NOT IN (0, 1)) t"""))
def validate_binary_lines(spark, folder):
    return checks.validate_binary(frames.orders_frame(spark, folder, ["n_lines"]), "n_lines")


@query(with_p("""
  SELECT rule, bad, bad = 0 AS ok FROM (
    SELECT 'missing' AS rule, count(*) FILTER (WHERE score_a = 0.5) AS bad FROM p
    UNION ALL SELECT 'not_finite', count(*) FILTER (WHERE score_a = 0) FROM p
    UNION ALL SELECT 'out_of_range',
      count(*) FILTER (WHERE score_a <> 0.5 AND score_a <> 0 AND score_a * 1.25 > 1) FROM p)"""))
def validate_predictions_scaled(spark, folder):
    s = F.col("score_a")
    bad = (F.when(s == 0.5, F.lit(None).cast("double")).when(s == 0, F.lit(float("nan"))).otherwise(s * 1.25))
    df = frames.orders_frame(spark, folder, ["score_a"]).select(bad.alias("p"))
    return checks.validate_predictions(df, "p")


@query(with_p("SELECT id, score_b AS target, segment FROM p WHERE split = 'test'"))
def apply_template_test_split(spark, folder):
    test = frames.orders_frame(spark, folder, ["id", "split", "segment", "score_b"]).where("split = 'test'")
    template = test.select("id", F.lit(0.0).alias("target"), "segment")
    return align.apply_template(template, test.select("id", F.col("score_b").alias("prediction")), "id", "target")


@query(f"""
  WITH p AS ({P}), c AS (SELECT count(*) FILTER (WHERE score_a <> score_b) AS n FROM p)
  SELECT rule, CAST(bad AS BIGINT) AS bad, bad = 0 AS ok FROM (
    SELECT 'row_count' AS rule, 0 AS bad UNION ALL SELECT 'missing_key', 0 UNION ALL SELECT 'extra_key', 0
    UNION ALL SELECT 'changed_value', n FROM c
    UNION ALL SELECT 'not_finite', 0 UNION ALL SELECT 'out_of_range', 0)""")
def verify_written_scores(spark, folder):
    """Writes one model's scores and verifies them against the other's: only values differ."""
    df = frames.orders_frame(spark, folder, ["id", "score_a", "score_b"])
    path = files.write_scored(df.select("id", F.col("score_a").alias("score")), work_folder(spark, "scored"), "id")
    return files.verify_written(path, df.select("id", F.col("score_b").alias("score")), "id", "score")


@query(with_p("SELECT id, 'a' AS model, score_a AS prediction FROM p UNION ALL SELECT id, 'b', score_b FROM p"))
def saved_predictions(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "score_a", "score_b"])
    path = work_folder(spark, "predictions")
    for model in ("a", "b"):
        files.save_predictions(df, path, model, "id", f"score_{model}")
    return spark.read.parquet(path).select("id", "model", "prediction")


@query(with_p("""
  SELECT segment AS run, round(rate, 6) AS value
  FROM (SELECT segment, avg(y) AS rate FROM p GROUP BY 1) ORDER BY rate DESC, segment DESC LIMIT 1"""))
def best_run_by_rate(spark, folder):
    rates = frames.orders_frame(spark, folder, ["segment", "y"]).groupBy("segment").agg(F.avg("y").alias("value"))
    metrics = rates.select(F.col("segment").alias("run"), F.lit("rate").alias("key"), "value")
    return rounded(ledger.best_run(metrics, "rate"))


@query(with_p("""SELECT id, split, amount, n_lines, region, CASE WHEN split = 'train' THEN CAST(y AS BIGINT) END AS target FROM p"""))
def loaded_pair(spark, folder):
    """Both splits written as text, then loaded under one contract: target coded, whole numbers whole."""
    df = frames.orders_frame(spark, folder, ["id", "split", "amount", "n_lines", "region", "target"])
    paths = {}
    for split in ("train", "test"):
        mine = df.where(F.col("split") == split).drop("split").withColumn("n_lines", F.col("n_lines").cast("double"))
        paths[split] = files.write_scored(mine if split == "train" else mine.drop("target"), work_folder(spark, split), "id")
    fields = contract.contract_of(df.drop("split").withColumn("n_lines", F.col("n_lines").cast("double")), "id", "target", ("n_lines",))
    train, test = files.load_pair(spark, paths["train"], paths["test"], fields)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumns({"split": F.lit("test"), "target": F.lit(None).cast("long")})))


@query(with_p("""
  SELECT * FROM (
    SELECT 0 AS position, 'amount' AS feature, count(amount) FILTER (WHERE split = 'train') AS train,
           count(amount) FILTER (WHERE split = 'test') AS test FROM p
    UNION ALL SELECT 1, 'region', count(region) FILTER (WHERE split = 'train'), count(region) FILTER (WHERE split = 'test') FROM p
    UNION ALL SELECT 2, 'qty', count(qty) FILTER (WHERE split = 'train'), count(qty) FILTER (WHERE split = 'test') FROM p) t"""))
def shared_features(spark, folder):
    """The features of both splits in their order, with the rows that know them."""
    df = checks.check_columns(frames.orders_frame(spark, folder, ["id", "split", "amount", "region", "qty", "y"]),
                              {"id", "split", "amount", "region", "qty", "y"})
    train = df.where("split = 'train'").drop("split")
    names = checks.column_parity(train, df.where("split = 'test'").drop("split", "y"), "id", "y")
    known = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"),
                      *[F.count_if(F.col(c).isNotNull() & (F.col("split") == s)).alias(s) for s in ("train", "test")])
             for i, c in enumerate(names)]
    return df.agg(F.array(*known).alias("known")).select(F.inline("known"))
