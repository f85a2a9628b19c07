import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propensity.operators import align, checks
from propensity.operators.checks import ContractError


def report(df):
    return {r["rule"]: r["bad"] for r in df.collect()}


def test_check_columns_names_both_sides(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert checks.check_columns(df, ["b", "a"]) is df
    with pytest.raises(ContractError, match=r"missing \['c'\], unexpected \['b'\]"):
        checks.check_columns(df, ["a", "c"])


def test_column_parity(spark):
    train = spark.createDataFrame([(1, 2, 3, 0)], "id int, a int, b int, y int")
    test = train.drop("y")
    assert checks.column_parity(train, test, "id", "y") == ["a", "b"]
    for bad in (train, test.drop("a"), test.select("id", "b", "a")):
        with pytest.raises(ContractError):
            checks.column_parity(train, bad, "id", "y")
    with pytest.raises(ContractError):
        checks.column_parity(test, test, "id", "y")


def test_strict_target(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "t string")
    assert [r[0] for r in checks.encode_target(df, "t").collect()] == [1, 0]
    for bad in ("Maybe", None, "yes"):
        with pytest.raises(PySparkException, match="target value not allowed"):
            checks.encode_target(spark.createDataFrame([(bad,)], "t string"), "t").collect()


def test_bad_targets_are_reported_with_counts(spark):
    df = spark.createDataFrame([("Yes",), ("Maybe",), ("Maybe",), (None,)], "t string")
    assert {r["t"]: r["count"] for r in checks.bad_targets(df, "t").collect()} == {"Maybe": 2, None: 1}


def test_lenient_target(spark):
    texts = [" YES\t", "no", "1", "0", "True", "false", "1.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in checks.encode_target(df, "t", strict=False).collect()] == [1, 0, 1, 0, 1, 0, 1]
    numbers = spark.createDataFrame([(1.0,), (0.0,)], "t double")
    assert [r[0] for r in checks.encode_target(numbers, "t", strict=False).collect()] == [1, 0]
    with pytest.raises(PySparkException):
        checks.encode_target(spark.createDataFrame([(2,)], "t int"), "t", strict=False).collect()


def test_coerce_integral(spark):
    df = spark.createDataFrame([(3.0, 1), (5.0, 2)], "a double, b long")
    out = checks.coerce_integral(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "bigint", "b": "bigint"}
    assert [r["a"] for r in out.collect()] == [3, 5]
    for bad in (3.5, None, math.nan):
        with pytest.raises(PySparkException, match="not a whole number"):
            checks.coerce_integral(spark.createDataFrame([(bad,)], "a double"), ["a"]).collect()


def test_validate_raw(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id long")
    assert report(checks.validate_raw(df, "id")) == {"empty": 0, "null_key": 1, "repeated_key": 1}
    assert report(checks.validate_raw(df.where("id > 9"), "id"))["empty"] == 1
    with pytest.raises(ContractError):
        checks.require(checks.validate_raw(df, "id"))
    with pytest.raises(ContractError, match="'y' is missing"):
        checks.validate_raw(df, "id", "y")


def test_validate_binary(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (math.nan,), (None,)], "y double")
    assert report(checks.validate_binary(df, "y")) == {"not_finite": 2, "not_binary": 1}


def test_validate_predictions(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (-0.1,), (math.nan,), (math.inf,), (None,)], "p double")
    assert report(checks.validate_predictions(df, "p")) == {"missing": 1, "not_finite": 2, "out_of_range": 2}


def template(spark):
    return spark.createDataFrame([(2, 0, "x"), (1, 0, "y")], "id long, t int, extra string")


def preds(spark, rows):
    return spark.createDataFrame(rows, "id long, prediction double")


def test_template_is_matched_by_key_not_position(spark):
    out = align.apply_template(template(spark), preds(spark, [(1, 0.25), (2, 0.75)]), "id", "t")
    assert out.columns == ["id", "t", "extra"]
    assert dict(out.dtypes)["id"] == "bigint"
    assert {(r["id"], r["t"], r["extra"]) for r in out.collect()} == {(2, 0.75, "x"), (1, 0.25, "y")}


@pytest.mark.parametrize("rows", [
    [(1, 0.1)], [(1, 0.1), (2, 0.2), (3, 0.3)], [(1, 0.1), (1, 0.2), (2, 0.3)], [(1, 0.1), (None, 0.2)],
    [(1, 1.5), (2, 0.2)], [(1, math.nan), (2, 0.2)], [(1, math.inf), (2, 0.2)], [(1, None), (2, 0.2)]])
def test_template_rejects(spark, rows):
    with pytest.raises(ContractError):
        align.apply_template(template(spark), preds(spark, rows), "id", "t")


def test_template_without_target(spark):
    with pytest.raises(ContractError, match="no column 't'"):
        align.apply_template(template(spark).drop("t"), preds(spark, [(1, 0.1), (2, 0.2)]), "id", "t")


def test_align_models_needs_every_key_finite(spark):
    a, b = preds(spark, [(1, 0.1), (2, 0.2)]), preds(spark, [(1, 0.3), (2, 0.4)])
    assert {tuple(r) for r in align.align_models({"a": a, "b": b}, "id").collect()} == {(1, 0.1, 0.3), (2, 0.2, 0.4)}
    for bad in (preds(spark, [(1, 0.3)]), preds(spark, [(1, 0.3), (2, math.nan)]), preds(spark, [(1, 0.3), (2, None)])):
        with pytest.raises(ContractError, match="do not align"):
            align.align_models({"a": a, "b": bad}, "id").collect()


def test_attach_rejects_other_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert align.attach(left, preds(spark, [(1, 0.1), (2, 0.2)]), "id").count() == 2
    with pytest.raises(ContractError):
        align.attach(left, preds(spark, [(1, 0.1), (3, 0.2)]), "id")


def test_overlap_and_mismatch(spark):
    a, b = (spark.createDataFrame([(i,) for i in ids], "id long") for ids in ([1, 2, 2, 3], [2, 4]))
    assert [r[0] for r in align.id_overlap(a, b, "id").collect()] == [2]
    assert {tuple(r) for r in align.id_mismatch(a, b, "id").collect()} == {(1, "left"), (3, "left"), (4, "right")}


def test_stack_rows_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    assert align.stack_rows(a, a.select(F.col("s"), F.col("i"))).collect()[1]["i"] == 1
