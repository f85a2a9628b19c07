"""Row-wise expressions. Each takes column names or Columns and returns a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The accepted texts of a yes/no target.
YES_NO = {"No": 0, "Yes": 1}
LENIENT_YES_NO = {"yes": 1, "no": 0, "1": 1, "0": 0, "true": 1, "false": 0}


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(mapping: Mapping[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def _or_fail(value: Column, message: str, shown: Column) -> Column:
    text = F.concat(F.lit(message + ": "), F.coalesce(shown.cast("string"), F.lit("null")))
    return F.coalesce(value, F.raise_error(text).cast("int"))


def strip(c: ColumnLike) -> Column:
    """Drop any leading and trailing whitespace, tabs and newlines included."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def finite(c: ColumnLike) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    x = _col(c).cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def target_strict(c: ColumnLike, mapping: Mapping[str, int] = YES_NO) -> Column:
    """Exact label to 0/1. Any other value, null included, fails the query."""
    return _or_fail(_lookup(mapping)[_col(c)], "target value not allowed", _col(c))


def target_lenient(c: ColumnLike) -> Column:
    """Label to 0/1 after trimming and lower-casing; numeric 0/1 and true/false pass."""
    text = F.lower(strip(_col(c).cast("string")))
    text = F.regexp_replace(text, r"^([01])\.0+$", "$1")
    return _or_fail(_lookup(LENIENT_YES_NO)[text], "target value not allowed", _col(c))


def integral(c: ColumnLike) -> Column:
    """Whole number held as a float, decimal or text, to long. A fraction or null fails the query."""
    x = _col(c)
    whole = F.when(x == F.floor(x), x.cast("long"))
    shown = F.coalesce(x.cast("string"), F.lit("null"))
    return F.coalesce(whole, F.raise_error(F.concat(F.lit("not a whole number: "), shown)).cast("long"))


def ordinal(c: ColumnLike, levels: Sequence[str], strict: bool = True) -> Column:
    """Position of the value in ``levels``. Unknown values fail, or give null when not strict."""
    code = _lookup({level: i for i, level in enumerate(levels)})[_col(c)]
    return _or_fail(code, "level not in order", _col(c)) if strict else code


def row_sum(a: ColumnLike, b: ColumnLike) -> Column:
    return (_col(a) + _col(b)).cast("long")


def row_diff(a: ColumnLike, b: ColumnLike) -> Column:
    """First minus second; swap the arguments for the opposite sign."""
    return (_col(a) - _col(b)).cast("long")


def ratio(num: ColumnLike, den: ColumnLike, offset: float = 0, on_zero: str = "null") -> Column:
    """num / (den + offset) as double.

    ``on_zero`` says what a zero denominator gives: "null", "inf" (signed infinity,
    NaN for 0/0) or "error".
    """
    top = _col(num).cast("double")
    bottom = (_col(den) + F.lit(offset)).cast("double") if offset else _col(den).cast("double")
    if on_zero == "error":
        return top / bottom
    if on_zero == "null":
        return F.try_divide(top, bottom)
    if on_zero != "inf":
        raise ValueError(f"on_zero must be null, inf or error, not {on_zero!r}")
    limit = (F.when(top > 0, F.lit(float("inf"))).when(top < 0, F.lit(float("-inf")))
             .when(top == 0, F.lit(float("nan"))))
    return F.when(bottom == 0, limit).otherwise(F.try_divide(top, bottom))


def flag(c: ColumnLike, value: object) -> Column:
    """1 where equal, else 0; null counts as not equal."""
    return F.coalesce((_col(c) == F.lit(value)).cast("int"), F.lit(0))


def flag_product(num: ColumnLike, flagged: Column) -> Column:
    """The number where the flag is set, else 0."""
    return _col(num) * flagged


def ordinal_product(num: ColumnLike, code: Column) -> Column:
    return _col(num) * code


def num_product(a: ColumnLike, b: ColumnLike) -> Column:
    return _col(a) * _col(b)


def cross(a: ColumnLike, b: ColumnLike, sep: str = "_") -> Column:
    """Text of both values joined; a missing value reads ``nan``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("nan")) for c in (a, b)]
    return F.concat_ws(sep, *parts)


def floor_mod(c: ColumnLike, modulus: int) -> Column:
    """Remainder with the sign of the modulus, as Python's ``%``."""
    return F.pmod(_col(c), F.lit(modulus))
