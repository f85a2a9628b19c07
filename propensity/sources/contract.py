"""What columns a table must have, their types and their roles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

KEY, NUMERIC, CATEGORICAL, TARGET = "key", "numeric", "categorical", "target"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    role: str
    # A whole number that arrives as a float; cast to long after a check.
    whole: bool = False


@dataclass(frozen=True)
class TableContract:
    fields: tuple[Field, ...]

    def names(self, *roles: str) -> list[str]:
        return [f.name for f in self.fields if not roles or f.role in roles]

    @property
    def key(self) -> str:
        return self.names(KEY)[0]

    @property
    def target(self) -> str | None:
        found = self.names(TARGET)
        return found[0] if found else None

    @property
    def numeric(self) -> list[str]:
        return self.names(NUMERIC)

    @property
    def categorical(self) -> list[str]:
        return self.names(CATEGORICAL)

    @property
    def whole(self) -> list[str]:
        return [f.name for f in self.fields if f.whole]

    def without_target(self) -> "TableContract":
        return TableContract(tuple(f for f in self.fields if f.role != TARGET))

    def type_of(self, name: str) -> str:
        return next(f.type for f in self.fields if f.name == name)


# The flat buyer table, its column names and types.
BUYERS = TableContract((
    Field("id", "long", KEY),
    Field("Age", "long", NUMERIC),
    Field("Annual_Income_USD", "double", NUMERIC),
    Field("Daily_Commute_km", "double", NUMERIC),
    Field("Number_of_Cars_Owned", "long", NUMERIC),
    Field("Charging_Stations_Near_Home", "long", NUMERIC),
    Field("Charging_Stations_Near_Work", "long", NUMERIC),
    Field("Environmental_Concern_Level", "double", NUMERIC, whole=True),
    Field("Gender", "string", CATEGORICAL),
    Field("City_Type", "string", CATEGORICAL),
    Field("Current_Car_Type", "string", CATEGORICAL),
    Field("Home_Charging_Possible", "string", CATEGORICAL),
    Field("Subsidy_Available", "string", CATEGORICAL),
    Field("Range_Anxiety_Level", "string", CATEGORICAL),
    Field("Will_Buy_EV", "string", TARGET),
))


def contract_of(df: DataFrame, key: str, target: str | None, whole: tuple[str, ...] = ()) -> TableContract:
    """Contract read off a frame: strings are categorical, the rest numeric."""
    fields = []
    for name, kind in df.dtypes:
        if name == key:
            role = KEY
        elif name == target:
            role = TARGET
        else:
            role = CATEGORICAL if kind == "string" else NUMERIC
        fields.append(Field(name, kind, role, name in whole))
    return TableContract(tuple(fields))
