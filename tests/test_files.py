import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from propensity.operators import encode
from propensity.operators.checks import ContractError
from propensity.sources import files, ledger
from propensity.sources.contract import BUYERS, Field, TableContract

SMALL = TableContract((Field("id", "long", "key"), Field("n", "double", "numeric", whole=True),
                       Field("c", "string", "categorical"), Field("t", "string", "target")))


def text(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = text(tmp_path, "a.csv", ["t,c,n,id", "Yes,red,3.0,7", "No,NA,nan,8"])
    rows = files.scan_csv(spark, path, SMALL).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(7, 3.0, "red", "Yes"), (8, None, None, "No")]


def test_scan_refuses_other_columns_and_bad_numbers(spark, tmp_path):
    with pytest.raises(ContractError, match=r"missing \['t'\], unexpected \['x'\]"):
        files.scan_csv(spark, text(tmp_path, "b.csv", ["id,n,c,x", "1,2,3,4"]), SMALL)
    with pytest.raises(PySparkException):
        files.scan_csv(spark, text(tmp_path, "c.csv", ["id,n,c,t", "1,many,red,Yes"]), SMALL).collect()


def test_parquet_scan_turns_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame([(1, math.nan, "a", "Yes")], "id long, n double, c string, t string")
    df.write.parquet(str(tmp_path / "p"))
    assert files.scan_parquet(spark, str(tmp_path / "p"), SMALL).first()["n"] is None


def test_load_pair(spark, tmp_path, buyers_7k):
    train, test = str(tmp_path / "train"), str(tmp_path / "test")
    buyers_7k.limit(300).write.option("header", True).csv(train)
    buyers_7k.where("id >= 6900").drop("Will_Buy_EV").write.option("header", True).csv(test)
    a, b = files.load_pair(spark, train, test, BUYERS)
    assert (a.count(), b.count()) == (300, 100)
    kinds = dict(a.dtypes)
    assert kinds["Will_Buy_EV"] == "bigint" and kinds["Environmental_Concern_Level"] == "bigint"
    assert "Will_Buy_EV" not in b.columns
    assert {r[0] for r in a.select("Will_Buy_EV").distinct().collect()} <= {0, 1}
    with pytest.raises(ContractError):
        files.load_pair(spark, test, test, BUYERS)
    with pytest.raises(ContractError):
        files.load_pair(spark, train, train, BUYERS)


@pytest.mark.parametrize("lines", [["1,3.5,red,Yes"], ["1,,red,Yes"], ["1,3.0,red,Maybe"], ["1,3.0,red,"]])
def test_load_pair_refuses_bad_values(spark, tmp_path, lines):
    train = text(tmp_path, "train.csv", ["id,n,c,t", *lines])
    test = text(tmp_path, "test.csv", ["id,n,c", "2,1.0,red"])
    with pytest.raises(PySparkException):
        files.load_pair(spark, train, test, SMALL)[0].collect()


def scored(spark):
    return spark.createDataFrame([(3, 0.25, "c"), (1, 1 / 3, "a"), (2, 0.1, "b")], "id long, t double, extra string")


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_write_and_verify(spark, tmp_path, form):
    df, path = scored(spark), str(tmp_path / "new" / "deep" / "scored")
    for _ in range(2):  # writing again gives the same content
        files.write_scored(df, path, "id", form)
        back = files.read_back(spark, path, df.schema, form)
        assert [tuple(r) for r in back.orderBy("id").collect()] == [tuple(r) for r in df.orderBy("id").collect()]
    assert all(r["ok"] for r in files.verify_written(path, df, "id", "t", form).collect())


def test_verify_finds_every_fault(spark, tmp_path):
    path = files.write_scored(scored(spark), str(tmp_path / "s"), "id", "parquet")
    meant = spark.createDataFrame([(1, 0.5), (2, 0.1), (4, 0.9), (5, 0.9)], "id long, t double")
    got = {r["rule"]: r["bad"] for r in files.verify_written(path, meant, "id", "t", "parquet").collect()}
    assert got == {"row_count": 1, "missing_key": 2, "extra_key": 1, "changed_value": 1, "not_finite": 0, "out_of_range": 0}
    bad = spark.createDataFrame([(1, 2.0), (2, math.nan)], "id long, t double")
    path = files.write_scored(bad, str(tmp_path / "b"), "id", "parquet")
    got = {r["rule"]: r["bad"] for r in files.verify_written(path, bad, "id", "t", "parquet").collect()}
    assert got["not_finite"] == 1 and got["out_of_range"] == 1
    with pytest.raises(ContractError):
        files.verify_written(path, bad.withColumnRenamed("t", "u"), "id", "u", "parquet")


def test_csv_is_in_key_order(spark, tmp_path):
    path = files.write_scored(scored(spark).repartition(3), str(tmp_path / "o"), "id")
    assert [r["id"] for r in spark.read.option("header", True).csv(path).collect()] == ["1", "2", "3"]


def test_predictions_and_fallback(spark, tmp_path):
    df = scored(spark).withColumnRenamed("t", "prediction")
    files.save_predictions(df, str(tmp_path / "preds"), "trees", "id")
    got = files.load_predictions(spark, str(tmp_path / "preds"), "trees", "id")
    assert got.count() == 3 and got.columns == ["id", "prediction"]
    csv = files.write_scored(scored(spark), str(tmp_path / "scored"), "id")
    got = files.load_predictions(spark, str(tmp_path / "preds"), "other", "id", csv, "t")
    assert {(r["id"], r["prediction"]) for r in got.collect()} == {(1, 1 / 3), (2, 0.1), (3, 0.25)}
    with pytest.raises(ContractError):
        files.load_predictions(spark, str(tmp_path / "preds"), "other", "id", csv, "nope")
    with pytest.raises(PySparkException):
        files.load_predictions(spark, str(tmp_path / "preds"), "other", "id")


def test_contract_roles():
    assert BUYERS.key == "id" and BUYERS.target == "Will_Buy_EV"
    assert len(BUYERS.numeric) == 7 and len(BUYERS.categorical) == 6
    assert BUYERS.without_target().target is None
    assert sorted(BUYERS.names()) == sorted([BUYERS.key, BUYERS.target, *BUYERS.numeric, *BUYERS.categorical])


def test_ledger(spark, tmp_path):
    book = ledger.RunLedger(spark, str(tmp_path / "ledger"))
    assert book.params().count() == 0
    a, b = book.start("one", {"note": 1}), book.start("two")
    book.append(a, {"learning_rate": 0.05, "num_leaves": 31}, {"auc": 0.94, "log_loss": 0.31})
    book.append(b, {}, {"auc": 0.95})
    for step, loss in enumerate([0.5, 0.4, 0.3]):
        book.append(a, metrics={"train_loss": loss}, step=step)
    assert {(r["key"], r["value"]) for r in book.params().collect()} == {("learning_rate", "0.05"), ("num_leaves", "31")}
    assert tuple(book.best("auc").first()) == (b, 0.95)
    steps = book.metrics().where("key = 'train_loss'").orderBy("step").collect()
    assert [(r["step"], r["value"]) for r in steps] == [(0, 0.5), (1, 0.4), (2, 0.3)]
    last = {(r["run"], r["key"]): r["value"] for r in ledger.last_values(book.metrics()).collect()}
    assert last[(a, "train_loss")] == 0.3 and last[(a, "auc")] == 0.94
    assert {r["name"] for r in book.runs().collect()} == {"one", "two"}


def levels(spark):
    train = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "c string, d string")
    return train, spark.createDataFrame([("z", "x")], "c string, d string")


@pytest.fixture(params=["few", "many"])
def ways(request):
    if request.param == "many":
        request.getfixturevalue("tiny_tasks")


def test_vocabulary_and_codes(spark, ways):
    train, test = levels(spark)
    vocab = encode.build_vocab(train, test, ["c", "d", "absent"])
    got = {(r["column"], r["level"]): r["code"] for r in vocab.collect()}
    assert got == {("c", "a"): 0, ("c", "b"): 1, ("c", "z"): 2, ("d", "x"): 0, ("d", "y"): 1}
    unseen = train.unionByName(spark.createDataFrame([("new", "x")], "c string, d string"))
    rows = encode.encode_codes(unseen, vocab, ["c", "d"], "_code").collect()
    assert {tuple(r) for r in rows} == {("b", "x", 1, 0), ("a", None, 0, None), ("b", "y", 1, 1), ("new", "x", None, 0)}


def test_one_hot_columns_agree_between_splits(spark):
    train, test = levels(spark)
    vocab = encode.build_vocab(train, test, ["c"])
    a, b = (encode.one_hot(df, vocab, ["c"], ["d"]) for df in (train, test))
    assert a.columns == b.columns == ["d", "c_a", "c_b", "c_z"]
    assert [tuple(r) for r in b.collect()] == [("x", 0, 0, 1)]
    assert a.agg(F.sum("c_b")).first()[0] == 2


def test_vocabulary_size_is_checked(spark):
    train, test = levels(spark)
    with pytest.raises(ContractError):
        encode.level_lists(encode.build_vocab(train, test, ["c", "d"]), 2)
