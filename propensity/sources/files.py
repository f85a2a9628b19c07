"""CSV and parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.functions import columns as fx
from propensity.operators import checks
from propensity.operators.checks import ContractError
from propensity.sources.contract import TableContract

# Texts read as missing.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def scan_csv(spark: SparkSession, path: str, contract: TableContract,
             na_values: Sequence[str] = NA_VALUES) -> DataFrame:
    """CSV with a header, columns matched by name, cast to the contract's types.

    All columns are read as text first: a declared schema would be applied by position
    and a file with swapped columns read wrongly without notice. Bad numbers fail the query.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    checks.check_columns(raw, contract.names(), path)

    def typed(name: str) -> Column:
        text = F.col(name)
        known = F.when(~text.isin(list(na_values)), text)
        kind = contract.type_of(name)
        return (known if kind == "string" else F.trim(known).cast(kind)).alias(name)

    return raw.select(*[typed(c) for c in contract.names()])


def scan_parquet(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """Parquet with exactly the contract's columns; NaN becomes null."""
    raw = checks.check_columns(spark.read.parquet(path), contract.names(), path)
    kinds = {f.name: f.dataType for f in raw.schema}

    def typed(name: str) -> Column:
        c = F.col(name)
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast("double"))
        return c.cast(contract.type_of(name)).alias(name)

    return raw.select(*[typed(c) for c in contract.names()])


def load_pair(spark: SparkSession, train_path: str, test_path: str, contract: TableContract,
              form: str = "csv") -> tuple[DataFrame, DataFrame]:
    """Train and test tables: columns checked, target 0/1, whole-number floats to long."""
    scan = {"csv": scan_csv, "parquet": scan_parquet}[form]
    if contract.target is None:
        raise ContractError("the training contract names no target")
    train = scan(spark, train_path, contract)
    test = scan(spark, test_path, contract.without_target())
    train = train.withColumn(contract.target, fx.target_strict(contract.target).cast("long"))
    return checks.coerce_integral(train, contract.whole), checks.coerce_integral(test, contract.whole)


def _save(df: DataFrame, path: str, form: str) -> None:
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", True).csv(path)
    elif form == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format must be csv or parquet, not {form!r}")


def write_scored(df: DataFrame, path: str, key: str, form: str = "csv") -> str:
    """Scored table, ordered by key across its files. Missing parent folders are made."""
    _save(df.orderBy(key), path, form)
    return path


def write_report(df: DataFrame, path: str, form: str = "csv") -> str:
    """Result table as files; struct columns are spread into plain ones for CSV."""
    if form == "csv":
        flat = []
        for f in df.schema:
            if isinstance(f.dataType, T.StructType):
                flat += [F.col(f"{f.name}.{g.name}").alias(f"{f.name}_{g.name}") for g in f.dataType]
            else:
                flat.append(F.col(f.name))
        df = df.select(*flat)
    _save(df, path, form)
    return path


def read_back(spark: SparkSession, path: str, schema: T.StructType, form: str = "csv") -> DataFrame:
    """A written table with its original types."""
    if form == "parquet":
        return spark.read.parquet(path)
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in raw.columns])


def verify_written(path: str, source: DataFrame, key: str, target: str, form: str = "csv") -> DataFrame:
    """Report of what was written against what was meant: one row per rule, from one keyed join."""
    found = read_back(source.sparkSession, path, source.schema, form)
    if target not in found.columns:
        raise ContractError(f"{path} has no column {target!r}")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("_k")).agg(
            F.count(F.lit(1)).alias(f"_n{name}"), F.max(F.col(target).cast("double")).alias(f"_p{name}"))

    both = side(source, "s").join(side(found, "f"), "_k", "full_outer")
    p = F.col("_pf")
    report = {
        "row_count": F.abs(F.coalesce(F.sum("_ns"), F.lit(0)) - F.coalesce(F.sum("_nf"), F.lit(0))),
        "missing_key": F.count_if(F.col("_nf").isNull()),
        "extra_key": F.count_if(F.col("_ns").isNull()),
        "changed_value": F.count_if(~F.col("_ps").eqNullSafe(p) & F.col("_nf").isNotNull() & F.col("_ns").isNotNull()),
        "not_finite": F.count_if(F.col("_nf").isNotNull() & ~fx.finite("_pf")),
        "out_of_range": F.count_if(fx.finite("_pf") & ((p < 0) | (p > 1))),
    }
    one = both.agg(*[m.cast("long").alias(n) for n, m in report.items()])
    return one.unpivot([], list(report), "rule", "bad").withColumn("ok", F.col("bad") == 0)


def save_predictions(df: DataFrame, path: str, model: str, key: str, value: str = "prediction") -> str:
    """One model's predictions as a partition of a shared table."""
    folder = f"{path.rstrip('/')}/model={model}"
    df.select(key, F.col(value).cast("double").alias("prediction")).write.mode("overwrite").parquet(folder)
    return folder


def load_predictions(spark: SparkSession, path: str, model: str, key: str, fallback: str | None = None,
                     fallback_target: str | None = None) -> DataFrame:
    """Predictions of ``model``, or the target column of a scored CSV when they were not saved."""
    from pyspark.errors import AnalysisException

    try:
        saved = spark.read.parquet(f"{path.rstrip('/')}/model={model}")
    except AnalysisException as error:
        # Only a table that is not there is replaced; a damaged one fails.
        if error.getCondition() != "PATH_NOT_FOUND" or fallback is None or fallback_target is None:
            raise
    else:
        return saved.select(key, "prediction")
    scored = spark.read.option("header", True).csv(fallback)
    if fallback_target not in scored.columns:
        raise ContractError(f"{fallback} has no column {fallback_target!r}; found {scored.columns}")
    return scored.select(F.col(key).cast("long").alias(key), F.col(fallback_target).cast("double").alias("prediction"))
