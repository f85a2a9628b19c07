"""Flat keyed frames over the star-schema tables.

``orders_frame`` joins only the tables its columns need and puts no hint on a join:
Catalyst picks the strategy from table sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions import columns as fx
from propensity.operators.features import Roles

CUSTOMER = {"balance", "nation", "segment", "rich"}
REGION = {"region"}
LINES = {"n_lines", "n_supp", "qty"}
ORDERS = ["id", "split", "amount", "priority", "urgency", "target", "y", "score_a", "score_b", "score_d"]
ALL = ["id", "split", "amount", "balance", "nation", "n_lines", "n_supp", "qty", "priority",
       "segment", "region", "rich", "urgency", "target", "y", "score_a", "score_b", "score_d"]

NUMBERS = ["amount", "balance", "nation", "n_lines", "n_supp", "qty"]
CATEGORIES = ["priority", "segment", "region", "rich", "urgency"]

# Which column of the orders frame plays which part in the feature formulas.
ROLES = Roles(age="nation", income="amount", commute="balance", home="n_lines", work="n_supp",
              concern="n_lines", subsidy="rich", charging="rich", anxiety="urgency",
              city="region", car="segment")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; NaN reads as null."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def orders_frame(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per order with the asked columns (default: all)."""
    want = list(columns or ALL)
    need = set(want)
    df = table(spark, folder, "orders")
    if need & (CUSTOMER | REGION):
        df = df.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if need & REGION:
        nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
        df = (df.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    if need & LINES:
        df = df.join(_lines_per_order(table(spark, folder, "lineitem"), need), "o_orderkey", "left")

    is_yes = F.col("o_orderstatus") == "F"
    key = F.col("o_orderkey")
    made = {
        "id": key,
        "split": F.when(key % 10 < 7, "train").otherwise("test"),
        "amount": F.col("o_totalprice"),
        "balance": F.col("c_acctbal"),
        "nation": F.col("c_nationkey"),
        "priority": F.col("o_orderpriority"),
        "segment": F.col("c_mktsegment"),
        "region": F.col("r_name"),
        "rich": F.when(F.col("c_acctbal") >= 5000, "Yes").otherwise("No"),
        "urgency": F.when(F.col("o_orderpriority") < "3", "High")
                    .when(F.col("o_orderpriority") < "5", "Medium").otherwise("Low"),
        "target": F.when(is_yes, "Yes").otherwise("No"),
        "y": F.when(is_yes, 1).otherwise(0),
        "score_a": ((key * 7919 + F.when(is_yes, 211).otherwise(0)) % 1000).cast("double") / 1000.0,
        # A whole number of 1/1024: its sums are exact in any order.
        "score_d": ((key * 7919 + F.when(is_yes, 211).otherwise(0)) % 1024).cast("double") / 1024.0,
        "score_b": ((key * 7877 + F.when(is_yes, 97).otherwise(0)) % 500).cast("double") / 500.0,
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in LINES},
    }
    return df.select(*[made[c].alias(c) for c in want])


def _lines_per_order(lines: DataFrame, need: set[str]) -> DataFrame:
    sums = {"n_lines": F.count(F.lit(1)), "n_supp": F.countDistinct("l_suppkey"),
            "qty": F.sum("l_quantity").cast("long")}
    return (lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(*[v.alias(k) for k, v in sums.items() if k in need]))


def events_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a purchase label and a label text that needs cleaning."""
    df = table(spark, folder, "events")
    kind = F.pmod("event_id", F.lit(4))
    text = (F.when(kind == 0, " YES\t").when(kind == 1, "no").when(kind == 2, "1").otherwise("0"))
    return df.select(F.col("event_id").alias("id"), "event_type", "user_id", "value",
                     (F.col("event_type") == "purchase").cast("int").alias("y"), text.alias("label_text"))


LINE_NUMBERS = ["quantity", "price", "line"]
LINE_CATEGORIES = ["status", "line", "discount", "tax"]


def lines_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a flat table without a key: returned or not, with a price score."""
    df = table(spark, folder, "lineitem")

    def percent(c: str):
        return F.round(F.col(c) * 100).cast("long")

    return df.select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_quantity").alias("quantity"),
                     F.col("l_extendedprice").alias("price"), F.col("l_linenumber").alias("line"),
                     F.col("l_linestatus").alias("status"), percent("l_discount").alias("discount"),
                     percent("l_tax").alias("tax"))


def documents_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents."""
    labels, docs = table(spark, folder, "labels"), table(spark, folder, "documents")
    return labels.join(docs.select("doc_id", "lang", "source", "n_chars"), "doc_id").withColumnRenamed("doc_id", "id")


def draw(name: str, key: str = "id"):
    """Uniform number in [0, 1) fixed by a name and the row key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{name}:"), F.col(key).cast("string"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 4294967296.0


def planted_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Orders frame whose target ``y`` follows four of its columns plus noise.

    The tables' own outcomes are random, so models are tried on this outcome.
    """
    base = orders_frame(spark, folder, [c for c in ALL if c not in ("target", "y", "score_a", "score_b", "score_d")])
    pull = (4.0 * fx.flag("rich", "Yes") + 2.0 * fx.ordinal("urgency", ROLES.anxiety_levels)
            + 1.6 * (F.col("n_lines") - 4) + (F.col("amount") - 250000.0) / 60000.0 - 5.4)
    chance = 1.0 / (1.0 + F.exp(-pull))
    return base.withColumn("y", (draw("outcome") < chance).cast("int"))
