"""Row-wise features over the orders frame."""

from pyspark.sql import functions as F

from propensity.catalog.registry import P, query, rounded, with_p
from propensity.functions import columns as fx
from propensity.operators import features
from propensity.sources import frames
from propensity.sources.frames import ROLES

ORD = "CASE urgency WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END"
RICH = "CASE WHEN rich = 'Yes' THEN 1 ELSE 0 END"


def _orders(spark, folder, *cols):
    return frames.orders_frame(spark, folder, ["id", *cols])


@query(with_p(f"SELECT id, CAST({ORD} AS INTEGER) AS code FROM p"))
def ordinal_urgency(spark, folder):
    return _orders(spark, folder, "urgency").select("id", fx.ordinal("urgency", ROLES.anxiety_levels).alias("code"))


@query(with_p("SELECT id, n_lines + n_supp AS total, n_lines - n_supp AS ahead, n_supp - n_lines AS behind FROM p"))
def row_sum_and_difference(spark, folder):
    return _orders(spark, folder, "n_lines", "n_supp").select(
        "id", fx.row_sum("n_lines", "n_supp").alias("total"), fx.row_diff("n_lines", "n_supp").alias("ahead"),
        fx.row_diff("n_supp", "n_lines").alias("behind"))


@query(with_p("""
  SELECT id, CASE WHEN n_lines <> 0 THEN round(amount / n_lines, 6) END AS plain,
         round(amount / (n_lines + 1), 6) AS shifted FROM p"""))
def ratio_amount_per_line(spark, folder):
    df = _orders(spark, folder, "amount", "n_lines")
    return rounded(df.select("id", fx.ratio("amount", "n_lines").alias("plain"),
                             fx.ratio("amount", "n_lines", offset=1).alias("shifted")))


@query(with_p(f"SELECT id, CAST({RICH} AS INTEGER) AS flag, n_lines * {RICH} AS lines_if, "
              f"round(amount * {RICH}, 6) AS amount_if FROM p"))
def flag_and_flag_product(spark, folder):
    on = fx.flag("rich", "Yes")
    df = _orders(spark, folder, "rich", "n_lines", "amount")
    return rounded(df.select("id", on.alias("flag"), fx.flag_product("n_lines", on).alias("lines_if"),
                             fx.flag_product("amount", on).alias("amount_if")))


@query(with_p(f"SELECT id, n_lines * {ORD} AS lines_x_urgency, round(amount * {ORD}, 6) AS amount_x_urgency, "
              "round(amount * n_lines, 4) AS amount_x_lines FROM p"))
def ordinal_and_number_products(spark, folder):
    code = fx.ordinal("urgency", ROLES.anxiety_levels)
    df = _orders(spark, folder, "urgency", "n_lines", "amount")
    return rounded(df.select("id", fx.ordinal_product("n_lines", code).alias("lines_x_urgency"),
                             fx.ordinal_product("amount", code).alias("amount_x_urgency"),
                             fx.num_product("amount", "n_lines").alias("amount_x_lines")), amount_x_lines=4)


@query(with_p("SELECT id, rich || '_' || urgency AS a, CAST(n_lines AS VARCHAR) || '_' || region AS b, "
              "coalesce(nullif(segment, 'BUILDING'), 'nan') || '_' || rich AS c FROM p"))
def cross_texts(spark, folder):
    df = _orders(spark, folder, "rich", "urgency", "n_lines", "region", "segment")
    gap = F.nullif(F.col("segment"), F.lit("BUILDING"))
    return df.select("id", fx.cross("rich", "urgency").alias("a"), fx.cross("n_lines", "region").alias("b"),
                     fx.cross(gap, "rich").alias("c"))


@query(with_p(f"""
  SELECT id, CAST({ORD} AS BIGINT) AS Anxiety_ord, n_lines + n_supp AS Stations_Total,
         CASE WHEN nation <> 0 THEN round(amount / nation, 6) END AS Income_per_Age,
         n_lines * {RICH} AS Env_x_Subsidy, round(amount * {RICH}, 6) AS Subsidy_x_Income,
         ({ORD}) * (n_lines + n_supp) AS Anxiety_x_Stations_Total FROM p"""))
def features_v1(spark, folder):
    df = features.build_features(frames.orders_frame(spark, folder), "v1", ROLES)
    return rounded(df.select("id", *features.V1_NAMES))


@query(with_p(f"""
  SELECT id, CAST({ORD} AS BIGINT) AS Anxiety_ord, n_lines + n_supp AS Stations_Total,
         n_lines - n_supp AS Stations_Difference,
         CASE WHEN nation <> 0 THEN round(amount / nation, 6) END AS Income_per_Age,
         CASE WHEN balance <> 0 THEN round(amount / balance, 4) END AS Income_per_Commute,
         n_lines * {RICH} AS Environmental_x_Subsidy, round(amount * {RICH}, 6) AS Income_x_Subsidy,
         n_lines * {RICH} AS Environmental_x_HomeCharging, round(amount * {RICH}, 6) AS Income_x_HomeCharging,
         n_lines * ({ORD}) AS Environmental_x_Anxiety, round(amount * ({ORD}), 6) AS Income_x_Anxiety,
         round(amount * n_lines, 4) AS Income_x_Environmental,
         rich || '_' || urgency AS Subsidy_x_Anxiety, rich || '_' || rich AS Subsidy_x_HomeCharging,
         rich || '_' || region AS Subsidy_x_City, rich || '_' || segment AS Subsidy_x_CarType,
         CAST(n_lines AS VARCHAR) || '_' || region AS Environmental_x_City FROM p"""))
def features_v2(spark, folder):
    df = features.build_features(frames.orders_frame(spark, folder), "v2", ROLES)
    return rounded(df.select("id", *features.V2_NAMES), Income_per_Commute=4, Income_x_Environmental=4)


MODS = (2, 3, 5, 10, 100)
_MOD_SQL = ", ".join(
    [f"((qty % {m}) + {m}) % {m} AS qty_mod_{m}" for m in MODS]
    + [f"round((((balance % {m}) + {m}) % {m}) + 0.0, 4) % {m} AS balance_mod_{m}" for m in MODS])


@query(with_p(f"SELECT id, {_MOD_SQL} FROM p"))
def mod_features(spark, folder):
    df = features.mod_features(_orders(spark, folder, "qty", "balance"), ["qty", "balance"], MODS)
    # A remainder just under the modulus may round up to it.
    tidy = {f"balance_mod_{m}": F.round(f"balance_mod_{m}", 4) % m for m in MODS}
    return df.select("id", *[f"qty_mod_{m}" for m in MODS], *[v.alias(k) for k, v in tidy.items()])


@query(with_p("SELECT id, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount, CAST(n_lines AS DOUBLE) AS n_lines FROM p"))
def float32_columns(spark, folder):
    df = features.as_float32(_orders(spark, folder, "amount", "n_lines"), ["amount", "n_lines"])
    return df.select("id", F.col("amount").cast("double"), F.col("n_lines").cast("double"))


@query(with_p("SELECT id, round(y - score_a, 6) + 0.0 AS residual, round(abs(y - score_a), 6) AS abs_residual FROM p"))
def residuals(spark, folder):
    df = features.residuals(_orders(spark, folder, "y", "score_a"), "y", "score_a")
    return rounded(df.select("id", "residual", "abs_residual"))


@query("SELECT source, count(*) AS count FROM documents GROUP BY 1 HAVING count(*) >= 50")
def groups_with_min_count(spark, folder):
    stats = frames.table(spark, folder, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    return features.filter_min_count(stats, 50)


@query(f"""SELECT id, amount, region FROM ({P})
           WHERE rich = 'Yes' AND n_lines > 0 AND nullif(segment, 'BUILDING') IS NOT NULL""")
def predicates_and_projection(spark, folder):
    df = _orders(spark, folder, "amount", "region", "rich", "n_lines", "segment")
    gaps = df.withColumn("segment", F.nullif(F.col("segment"), F.lit("BUILDING")))
    kept = gaps.where((F.col("rich") == "Yes") & (F.col("n_lines") > 0)).dropna(subset=["segment"])
    return kept.drop("rich", "n_lines", "segment")
