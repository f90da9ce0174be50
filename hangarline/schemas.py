"""Warehouse schema: column types, keys, references and measures of every table."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    column: str
    table: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    measures: tuple[str, ...] = ()
    lookup: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]

    def conform(self, df: DataFrame) -> DataFrame:
        """Projects to the declared columns, order and types."""
        require_columns(df, self.columns, self.name)
        return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required columns {missing}")


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _I, _L, _D, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()
_AIRCRAFT, _DAY, _MONTH = (Reference("aircraft_id", "aircraft"), Reference("date_id", "date"), Reference("month_id", "month"))

# Names, types, keys and measures of the warehouse tables.
DATE = TableSpec(
    "date",
    _schema(("date_id", _DATE, False), ("day", _I, True), ("month", _I, True), ("year", _I, True)),
    key=("date_id",),
    lookup=("date_id",),
)
MONTH = TableSpec(
    "month",
    _schema(("month_id", _I, False), ("month", _I, False), ("year", _I, False)),
    key=("month_id",),
    lookup=("month_id",),
)
AIRCRAFT = TableSpec(
    "aircraft",
    _schema(("aircraft_id", _S, False), ("model", _S, True), ("manufacturer", _S, True)),
    key=("aircraft_id",),
    lookup=("aircraft_id",),
)
FLIGHTS = TableSpec(
    "flights",
    _schema(
        ("aircraft_id", _S, False),
        ("date_id", _DATE, False),
        ("flight_hours", _D, True),
        ("takeoff", _L, True),
        ("delays", _L, True),
        ("delay_minutes", _D, True),
        ("cancellations", _L, True),
    ),
    key=("aircraft_id", "date_id"),
    references=(_AIRCRAFT, _DAY),
    measures=("flight_hours", "takeoff", "delays", "delay_minutes", "cancellations"),
)
UNAVAILABILITY = TableSpec(
    "unavailability",
    _schema(("aircraft_id", _S, False), ("month_id", _I, False), ("type", _S, False), ("days", _D, True)),
    key=("aircraft_id", "month_id", "type"),
    references=(_AIRCRAFT, _MONTH),
    measures=("days",),
)
REPORTS = TableSpec(
    "reports",
    _schema(
        ("report_id", _L, False),
        ("aircraft_id", _S, False),
        ("date_id", _DATE, False),
        ("reporter_class", _S, False),
        ("airport", _S, True),
        ("source", _S, True),
    ),
    key=("report_id",),
    references=(_AIRCRAFT, _DAY),
    measures=("airport", "reporter_class", "source"),
)

DIMENSIONS = (DATE, MONTH, AIRCRAFT)
FACTS = (FLIGHTS, UNAVAILABILITY, REPORTS)
TABLES = {spec.name: spec for spec in DIMENSIONS + FACTS}

# The two reference files.
AIRCRAFT_LOOKUP_FILE = _schema(
    ("aircraft_reg_code", _S, True),
    ("manufacturer_serial_number", _S, True),
    ("aircraft_model", _S, True),
    ("aircraft_manufacturer", _S, True),
)
PERSONNEL_FILE = _schema(("reporteurid", _L, True), ("airport", _S, True))


def year_of(df: DataFrame) -> Column:
    """Year of a fact row; a stored year partition column is used as is so that it can prune."""
    if "year" in df.columns:
        return F.col("year")
    if "month_id" in df.columns:
        return F.expr("CAST(month_id div 100 AS INT)")
    return F.year("date_id")
