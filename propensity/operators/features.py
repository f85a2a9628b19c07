"""Feature sets, feature discovery and row-wise derivations.

Each set is one projection over the input: raw columns stay, features are appended.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as fx


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in the feature formulas."""

    age: str = "Age"
    income: str = "Annual_Income_USD"
    commute: str = "Daily_Commute_km"
    home: str = "Charging_Stations_Near_Home"
    work: str = "Charging_Stations_Near_Work"
    concern: str = "Environmental_Concern_Level"
    subsidy: str = "Subsidy_Available"
    charging: str = "Home_Charging_Possible"
    anxiety: str = "Range_Anxiety_Level"
    city: str = "City_Type"
    car: str = "Current_Car_Type"
    # Order of the anxiety levels and the text of a set flag.
    anxiety_levels: tuple[str, ...] = ("High", "Medium", "Low")
    yes: str = "Yes"


def _v1(r: Roles, on_zero: str) -> dict[str, Column]:
    order = fx.ordinal(r.anxiety, r.anxiety_levels).cast("long")
    stations = fx.row_sum(r.home, r.work)
    subsidised = fx.flag(r.subsidy, r.yes)
    return {
        "Anxiety_ord": order,
        "Stations_Total": stations,
        "Income_per_Age": fx.ratio(r.income, r.age, on_zero=on_zero),
        "Env_x_Subsidy": fx.flag_product(r.concern, subsidised),
        "Subsidy_x_Income": fx.flag_product(r.income, subsidised),
        "Anxiety_x_Stations_Total": fx.ordinal_product(stations, order),
    }


def _v2(r: Roles, on_zero: str) -> dict[str, Column]:
    order = fx.ordinal(r.anxiety, r.anxiety_levels).cast("long")
    numbers = {"Environmental": r.concern, "Income": r.income}
    flags = {"Subsidy": fx.flag(r.subsidy, r.yes), "HomeCharging": fx.flag(r.charging, r.yes)}
    partners = {"Anxiety": r.anxiety, "HomeCharging": r.charging, "City": r.city, "CarType": r.car}

    out = {
        "Anxiety_ord": order,
        "Stations_Total": fx.row_sum(r.home, r.work),
        "Stations_Difference": fx.row_diff(r.home, r.work),
        "Income_per_Age": fx.ratio(r.income, r.age, on_zero=on_zero),
        "Income_per_Commute": fx.ratio(r.income, r.commute, on_zero=on_zero),
    }
    out |= {f"{n}_x_{f}": fx.flag_product(c, on)
            for f, on in flags.items() for n, c in numbers.items()}
    out |= {f"{n}_x_Anxiety": fx.ordinal_product(c, order) for n, c in numbers.items()}
    out["Income_x_Environmental"] = fx.num_product(r.income, r.concern)
    out |= {f"Subsidy_x_{n}": fx.cross(r.subsidy, c) for n, c in partners.items()}
    out["Environmental_x_City"] = fx.cross(r.concern, r.city)
    return out


FEATURE_SETS = {"v1": _v1, "v2": _v2}


def feature_names(spec: str = "v1") -> list[str]:
    """Names a feature set appends, in order."""
    return {"v1": V1_NAMES, "v2": V2_NAMES}[spec]


# Appended column names in order.
V1_NAMES = ["Anxiety_ord", "Stations_Total", "Income_per_Age", "Env_x_Subsidy",
            "Subsidy_x_Income", "Anxiety_x_Stations_Total"]
V2_NAMES = ["Anxiety_ord", "Stations_Total", "Stations_Difference", "Income_per_Age",
            "Income_per_Commute", "Environmental_x_Subsidy", "Income_x_Subsidy",
            "Environmental_x_HomeCharging", "Income_x_HomeCharging", "Environmental_x_Anxiety",
            "Income_x_Anxiety", "Income_x_Environmental", "Subsidy_x_Anxiety",
            "Subsidy_x_HomeCharging", "Subsidy_x_City", "Subsidy_x_CarType", "Environmental_x_City"]


def build_features(df: DataFrame, spec: str = "v1", roles: Roles = Roles(),
                   on_zero: str = "null") -> DataFrame:
    """Append feature set ``v1`` (6 columns) or ``v2`` (17 columns)."""
    return df.withColumns(FEATURE_SETS[spec](roles, on_zero))


def mod_features(df: DataFrame, cols: Sequence[str],
                 mods: Sequence[int] = (2, 3, 5, 10, 100)) -> DataFrame:
    """Append ``<col>_mod_<m>``, the floored remainder, for every column and modulus."""
    return df.withColumns({f"{c}_mod_{m}": fx.floor_mod(c, m) for c in cols for m in mods})


def discover_features(df: DataFrame, key: str, target: str | None = None,
                      declared: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """All feature columns, and the categorical ones: declared first, then other strings."""
    features = [c for c in df.columns if c not in (key, target)]
    cats = [c for c in declared if c in features]
    cats += [c for c, kind in df.dtypes if kind == "string" and c in features and c not in cats]
    return features, cats


def as_float32(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict cast to float; text that is no number fails the query."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    """Append ``residual`` (y - p) and ``abs_residual``."""
    gap = F.col(y) - F.col(p)
    return df.withColumns({"residual": gap, "abs_residual": F.abs(gap)})


def filter_min_count(stats: DataFrame, n: int, count: str = "count") -> DataFrame:
    """Keep the groups that have at least ``n`` rows."""
    return stats.where(F.col(count) >= n)
