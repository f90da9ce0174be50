"""Readers for the six operational tables and the two reference files.

Every reader returns lazy DataFrames in the source's own column names; nothing is fetched here.
"""

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from hangarline import schemas
from hangarline.sources.settings import ConnectionSettings


def _same(df: DataFrame) -> DataFrame:
    return df


class SourceTables:
    """The six tables and the two files, each opened when it is first used.

    A build needs neither work orders nor maintenance events, and opening a table may ask a database.
    """

    NAMES = (
        "flights",
        "maintenance",
        "workorders",
        "maintenanceevents",
        "postflightreports",
        "technicallogbookorders",
        "aircraft_lookup",
        "personnel",
    )

    def __init__(self, readers: Mapping[str, Callable[[], DataFrame]]):
        missing = [name for name in self.NAMES if name not in readers]
        if missing:
            raise ValueError(f"no reader for {missing}")
        self._readers = dict(readers)
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, **frames: DataFrame) -> "SourceTables":
        return cls({name: partial(_same, df) for name, df in frames.items()})

    def with_frames(self, **frames: DataFrame) -> "SourceTables":
        return SourceTables(self._readers | {name: partial(_same, df) for name, df in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self._readers[name]()
        return self._opened[name]


# Schema-qualified table names, and the column each table is split on when it is
# read in parallel (None: only the distinct registrations are needed, see `jdbc_query`).
JDBC_TABLES = {
    "flights": ('"AIMS".flights', "scheduleddeparture"),
    "maintenance": ('"AIMS".maintenance', "scheduleddeparture"),
    "workorders": ('"AMOS".workorders', None),
    "maintenanceevents": ('"AMOS".maintenanceevents', None),
    "postflightreports": ('"AMOS".postflightreports', "reportingdate"),
    "technicallogbookorders": ('"AMOS".technicallogbookorders', "reportingdate"),
}


# The source columns that are used.
SOURCE_COLUMNS = {
    "flights": [
        "aircraftregistration",
        "scheduleddeparture",
        "scheduledarrival",
        "actualdeparture",
        "actualarrival",
        "cancelled",
    ],
    "maintenance": ["aircraftregistration", "scheduleddeparture", "scheduledarrival", "programmed"],
    "postflightreports": ["reporteurid", "aircraftregistration", "reportingdate", "reporteurclass"],
    "technicallogbookorders": ["reporteurid", "aircraftregistration", "reportingdate", "reporteurclass"],
}


def jdbc_query(name: str) -> str:
    """Subquery to read: the used columns, report days as dates, registrations reduced at the source."""
    table, split_column = JDBC_TABLES[name]
    if split_column is None:
        return f"(SELECT DISTINCT aircraftregistration FROM {table}) AS {name}"
    columns = [c.replace("reportingdate", "reportingdate::date AS reportingdate") for c in SOURCE_COLUMNS[name]]
    return f"(SELECT {', '.join(columns)} FROM {table}) AS {name}"


def _literal(value: date) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ', timespec='microseconds')}'"
    return f"DATE '{value.isoformat()}'"


def cut_predicates(column: str, cuts: Sequence[date]) -> list[str]:
    """Conditions that deal every row to one read: ranges up to each cut, one beyond the last, and one for NULL.

    Plain comparisons work for any type that the column has, and the database can use its index for them.
    """
    points = [_literal(cut) for cut in cuts]
    if not points:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(points, points[1:], strict=False)]
    return [f"{column} <= {points[0]}", *inner, f"{column} > {points[-1]}", f"{column} IS NULL"]


def even_cuts(lower: datetime, upper: datetime, partitions: int) -> list[datetime]:
    """Cuts of equal distance, for bounds that the caller states."""
    step = (upper - lower) / partitions
    return [lower + i * step for i in range(1, partitions)]


def range_predicates(column: str, lower: datetime, upper: datetime, partitions: int) -> list[str]:
    """Conditions for ranges of equal width, open at both ends."""
    return cut_predicates(column, even_cuts(lower, upper, partitions))


def quantile_query(table: str, column: str, partitions: int) -> str:
    """The last value of each of so many groups of equally many rows, in order. The database sorts or walks an index.

    Rows that share a value may fall into two groups here; the ranges made from it keep them together.
    """
    ranked = f"SELECT {column}, ntile({partitions}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"(SELECT max({column}) AS cut FROM ({ranked}) AS ranked GROUP BY part) AS cuts"


def distinct_cuts(values: Iterable[date]) -> list[date]:
    """Cuts from the groups' last values: each once, without the largest, beyond which nothing lies."""
    return sorted(set(values))[:-1]


def jdbc_options(settings: ConnectionSettings, name: str, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read of one source table."""
    return {
        "url": settings.url,
        "user": settings.user,
        "password": settings.password,
        "driver": "org.postgresql.Driver",
        "dbtable": jdbc_query(name),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }


def jdbc_cuts(spark: SparkSession, options: dict[str, str], column: str, partitions: int) -> list[date]:
    """Cuts that give ranges of equally many rows, computed by the database: one row for each range."""
    query = quantile_query(options["dbtable"], column, partitions)
    rows = spark.read.format("jdbc").options(**(options | {"dbtable": query})).load().collect()
    return distinct_cuts(row.cut for row in rows)


def jdbc_tables(
    spark: SparkSession,
    settings: ConnectionSettings,
    lookup_csv: str,
    personnel_csv: str,
    lower: datetime | None = None,
    upper: datetime | None = None,
    partitions: int = 1,
) -> SourceTables:
    def read(name: str) -> DataFrame:
        options, column = jdbc_options(settings, name), JDBC_TABLES[name][1]
        if column is None or partitions < 2:
            return spark.read.format("jdbc").options(**options).load()
        if lower is not None and upper is not None:
            ranges = range_predicates(column, lower, upper, partitions)
        else:
            ranges = cut_predicates(column, jdbc_cuts(spark, options, column, partitions))
        others = {key: value for key, value in options.items() if key not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=ranges, properties=others)

    return SourceTables({name: partial(read, name) for name in JDBC_TABLES} | _files(spark, lookup_csv, personnel_csv))


def parquet_tables(spark: SparkSession, folder: str, lookup_csv: str, personnel_csv: str) -> SourceTables:
    """The same tables as parquet datasets `<folder>/<table>`."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    return SourceTables({name: partial(read, name) for name in JDBC_TABLES} | _files(spark, lookup_csv, personnel_csv))


def _files(spark: SparkSession, lookup_csv: str, personnel_csv: str) -> dict[str, Callable[[], DataFrame]]:
    return {
        "aircraft_lookup": partial(aircraft_lookup_csv, spark, lookup_csv),
        "personnel": partial(personnel_csv_or_empty, spark, personnel_csv),
    }


def landed(src: SourceTables, folder: str) -> SourceTables:
    """Copies the four large tables a build reads to parquet, so that several builds or comparisons read a database once.

    A build reads each of them once in any case.
    """
    needed = ("flights", "maintenance", "postflightreports", "technicallogbookorders")
    for name in needed:
        getattr(src, name).select(*SOURCE_COLUMNS[name]).write.parquet(f"{folder}/{name}")
    spark = src.flights.sparkSession
    return src.with_frames(**{name: spark.read.parquet(f"{folder}/{name}") for name in needed})


def aircraft_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.AIRCRAFT_LOOKUP_FILE)


def personnel_csv_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The personnel file is optional: without it no report gets an airport."""
    try:
        return _csv(spark, path, schemas.PERSONNEL_FILE)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.PERSONNEL_FILE)


def _csv(spark: SparkSession, path: str, schema) -> DataFrame:
    # Columns are matched by header name, so extra or reordered columns do no harm.
    header = spark.read.option("header", True).csv(path)
    schemas.require_columns(header, schema.fieldNames(), path)
    return header.select([header[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
