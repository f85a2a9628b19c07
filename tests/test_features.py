import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propensity.functions import columns as fx
from propensity.operators import features
from propensity.operators.features import V1_NAMES, V2_NAMES, build_features
from propensity.sources.contract import BUYERS


@pytest.fixture(scope="module")
def three(spark):
    cols = ("id long, Age long, Annual_Income_USD double, Daily_Commute_km double, Charging_Stations_Near_Home long, "
            "Charging_Stations_Near_Work long, Environmental_Concern_Level long, Subsidy_Available string, "
            "Home_Charging_Possible string, Range_Anxiety_Level string, City_Type string, Current_Car_Type string")
    return spark.createDataFrame([
        (1, 25, 30000.0, 10.0, 0, 0, 1, "Yes", "No", "High", "Urban", "SUV"),
        (2, 50, 80000.0, 20.0, 5, 10, 3, "No", "Yes", "Medium", "Rural", "Sedan"),
        (3, 70, 200000.0, 0.0, 14, 19, 5, "No", "Yes", "Low", "Suburban", "Truck")], cols)


def column(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_v1_formulas(three):
    out = build_features(three, "v1")
    assert out.columns == [*three.columns, *V1_NAMES]
    assert column(out, "Anxiety_ord") == [0, 1, 2]
    assert column(out, "Stations_Total") == [0, 15, 33]
    assert column(out, "Env_x_Subsidy") == [1, 0, 0]
    assert column(out, "Subsidy_x_Income") == [30000.0, 0.0, 0.0]
    assert column(out, "Anxiety_x_Stations_Total") == [0, 15, 66]
    assert column(out, "Income_per_Age") == pytest.approx([1200, 1600, 2857.142857142857])


def test_v2_formulas(three):
    out = build_features(three, "v2")
    assert out.columns == [*three.columns, *V2_NAMES]
    assert column(out, "Stations_Difference") == [0, -5, -5]
    assert column(out, "Income_per_Commute") == [3000.0, 4000.0, None]
    assert column(out, "Environmental_x_HomeCharging") == [0, 3, 5]
    assert column(out, "Income_x_Environmental") == [30000.0, 240000.0, 1000000.0]
    assert column(out, "Income_x_Anxiety") == [0.0, 80000.0, 400000.0]
    assert column(out, "Subsidy_x_Anxiety") == ["Yes_High", "No_Medium", "No_Low"]
    assert column(out, "Environmental_x_City") == ["1_Urban", "3_Rural", "5_Suburban"]


def test_input_is_not_changed_and_result_is_repeatable(three):
    before = three.collect()
    once = build_features(three, "v2").collect()
    assert three.collect() == before
    assert build_features(three, "v2").collect() == once


def test_features_of_buyers_have_no_gaps(buyers_7k):
    out = build_features(buyers_7k, "v2")
    gaps = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in V2_NAMES]).first()
    assert not any(gaps)


def test_ratio_on_zero(three):
    def last(how):
        return column(three.withColumn("r", fx.ratio("Annual_Income_USD", "Daily_Commute_km", on_zero=how)), "r")[2]

    assert last("null") is None
    assert last("inf") == math.inf
    with pytest.raises(PySparkException):
        last("error")
    with pytest.raises(ValueError):
        fx.ratio("a", "b", on_zero="zero")


def test_unknown_ordinal_level_fails(three):
    bad = three.withColumn("Range_Anxiety_Level", F.lit("Huge"))
    with pytest.raises(PySparkException, match="Huge"):
        build_features(bad, "v1").collect()
    assert column(bad.withColumn("c", fx.ordinal("Range_Anxiety_Level", ["High"], strict=False)), "c") == [None] * 3


def test_flag_of_null_is_zero_and_cross_of_null_is_nan(spark):
    df = spark.createDataFrame([(None, "b"), ("Yes", None)], "a string, b string")
    rows = df.select(fx.flag("a", "Yes").alias("f"), fx.cross("a", "b").alias("x")).collect()
    assert [(r.f, r.x) for r in rows] == [(0, "nan_b"), (1, "Yes_nan")]


def test_floor_mod_equals_python(spark):
    values = [(-7, -7.5), (7, 7.5), (0, 0.0), (-1, -0.25)]
    df = spark.createDataFrame(values, "i long, d double")
    rows = df.select(*[fx.floor_mod(c, m).alias(f"{c}{m}") for c in "id" for m in (2, 3, 10)]).collect()
    for (i, d), r in zip(values, rows):
        for m in (2, 3, 10):
            assert r[f"i{m}"] == i % m and r[f"d{m}"] == pytest.approx(d % m)


def test_discovery_orders_declared_first(buyers_7k):
    built = build_features(buyers_7k, "v2")
    names, cats = features.discover_features(built, "id", "Will_Buy_EV", BUYERS.categorical)
    assert "id" not in names and "Will_Buy_EV" not in names and len(names) == 13 + 17
    assert cats == [*BUYERS.categorical, "Subsidy_x_Anxiety", "Subsidy_x_HomeCharging", "Subsidy_x_City",
                    "Subsidy_x_CarType", "Environmental_x_City"]


def test_as_float32_refuses_text(spark):
    with pytest.raises(PySparkException):
        features.as_float32(spark.createDataFrame([("x",)], "a string"), ["a"]).collect()


def test_strip_removes_any_whitespace(spark):
    df = spark.createDataFrame([("\t YES \n",)], "a string")
    assert df.select(fx.strip("a")).first()[0] == "YES"


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,), (-math.inf,), (math.nan,), (None,)], "a double")
    assert [r[0] for r in df.select(fx.finite("a")).collect()] == [True, False, False, False, False]
