"""Vocabularies, codes and one-hot columns."""

from propensity.catalog.registry import P, flat, query
from propensity.operators import encode
from propensity.sources import frames

COLS = ["region", "segment", "priority"]

_LEVELS = " UNION ".join(f"SELECT '{c}' AS \"column\", {c} AS level FROM p WHERE {c} IS NOT NULL" for c in COLS)
_VOCAB = (f"WITH p AS ({P}), l AS ({_LEVELS}), v AS (SELECT \"column\", level, "
          "CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY level) - 1 AS INTEGER) AS code FROM l)")


def _vocab(spark, folder):
    df = flat(spark, folder, ["split", *COLS])
    return encode.build_vocab(df.where("split = 'train'"), df.where("split = 'test'"), COLS)


@query(f'{_VOCAB} SELECT "column", level, code FROM v')
def vocabulary(spark, folder):
    return _vocab(spark, folder)


@query(f"{_VOCAB} SELECT id, " + ", ".join(
    f"(SELECT code FROM v WHERE \"column\" = '{c}' AND level = p.{c}) AS {c}" for c in COLS) + " FROM p")
def encoded_codes(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", *COLS])
    return encode.encode_codes(df, _vocab(spark, folder), COLS)


_HOT = {"region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
        "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}


@query(f"WITH p AS ({P}) SELECT id, amount, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c in COLS for v in _HOT[c]) + " FROM p")
def one_hot_columns(spark, folder):
    df = frames.orders_frame(spark, folder, ["id", "amount", *COLS])
    return encode.one_hot(df, _vocab(spark, folder), COLS, keep=["id", "amount"])
