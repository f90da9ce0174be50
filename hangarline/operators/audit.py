"""What the quality rules corrected or dropped, as one typed table."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline import schemas
from hangarline.operators import checks, facts, quality

AUDIT_TYPES = {
    "rule": "string",
    "aircraft_id": "string",
    "departure": "timestamp_ntz",
    "arrival": "timestamp_ntz",
    "date_id": "date",
    "month_id": "int",
    "reporter_class": "string",
    "source": "string",
    "copies": "bigint",
}


#: The rule of daily flights that cannot be loaded.
UNKNOWN_FLIGHTS = "FK-FLIGHTS"


def _entries(rows: DataFrame) -> DataFrame:
    """Audit entries: equal ones are one row with their number. Columns that rows lack are NULL."""
    values = {name: F.col(name) if name in rows.columns else F.lit(None) for name in AUDIT_TYPES}
    entries = rows.select([values[name].cast(kind).alias(name) for name, kind in AUDIT_TYPES.items()])
    keys = [name for name in AUDIT_TYPES if name != "copies"]
    return entries.groupBy(*keys).agg(F.sum("copies").alias("copies"))


def _told(rows: DataFrame, *entries: dict[str, Column]) -> DataFrame:
    """One row for each entry that counts for something."""
    structs = [F.struct(*[value.alias(name) for name, value in entry.items()]) for entry in entries]
    return rows.select("aircraft_id", F.explode(F.array(*structs)).alias("entry")).select("aircraft_id", "entry.*").where("copies <> 0")


def flight_entries(flights: DataFrame, departures: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Repaired flights, with the times as they arrived; removed ones; days of unknown aircraft that cannot be loaded.

    flights: after BR-23, with `copies`. departures: what BR-21 decided for them, with the sum `uncontested`. A flight
    that BR-21 can remove counts as removed, and a survivor takes one of the removed ones back, so kept and removed
    flights need not be brought together row by row: short entries are summed once.
    """
    departure, arrival, day, none = F.col("actualdeparture"), F.col("actualarrival"), F.lit(None).cast("date"), F.lit(None).cast("timestamp_ntz")

    def entry(rule: str, copies: Column, departure: Column = none, arrival: Column = none, date_id: Column = day) -> dict[str, Column]:
        return {"rule": F.lit(rule), "departure": departure, "arrival": arrival, "date_id": date_id, "copies": copies.cast("long")}

    def if_(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(0)

    corrected = _told(
        flights,
        entry("BR-23", if_(F.col("times_swapped"), F.col("copies")), arrival, departure),
        entry("BR-21", if_(quality.contestable(), F.col("copies")), departure, arrival),
    )
    has_day = F.expr("(survives OR uncontested > 0) AND aircraft_id IS NOT NULL AND date_id IS NOT NULL")
    decided = _told(
        departures,
        entry("BR-21", if_(F.col("survives"), F.lit(-1)), F.col("departure"), F.col("arrival")),
        entry(UNKNOWN_FLIGHTS, if_(has_day, F.lit(1)), date_id=F.col("date_id")),
    )
    known = aircraft.select("aircraft_id", F.lit(UNKNOWN_FLIGHTS).alias("rule"))
    entries = _entries(corrected.unionByName(decided)).where("copies > 0").join(known, ["rule", "aircraft_id"], "left_anti")
    copies = F.when(F.col("rule") == UNKNOWN_FLIGHTS, 1).otherwise(F.col("copies"))
    return entries.withColumn("copies", copies.cast("long")).select(*AUDIT_TYPES)


def report_entries(reports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Reports on unknown aircraft, and reports on known ones that lack a required value, from one pass.

    Equal reports are counted before they meet the aircraft. reports: with `copies`, or one row for each.
    """
    described = ["aircraft_id", "date_id", "reporter_class", "source"]
    number = F.col("copies") if "copies" in reports.columns else F.lit(1)
    counted = quality.normalised(reports).groupBy(*described).agg(F.sum(number).alias("copies"))
    known = aircraft.select("aircraft_id", F.lit(True).alias("is_known"))
    missing = reduce(or_, [F.col(c).isNull() for c in facts.REPORT_REQUIRED])
    rule = F.when(F.col("is_known").isNull(), "BR-UA").when(missing, "NOT-NULL")
    judged = counted.join(known, "aircraft_id", "left").withColumn("rule", rule)
    return _entries(judged.where("rule IS NOT NULL"))


def slot_entries(unavailability: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Downtime of aircraft outside the dimension: it cannot be loaded."""
    rows = checks.orphans(unavailability, schemas.UNAVAILABILITY.references[0], aircraft)
    return _entries(rows.select("aircraft_id", "month_id", F.lit("FK-UNAVAILABILITY").alias("rule"), F.lit(1).alias("copies")))


def dq_audit(
    flights: DataFrame, departures: DataFrame, reports: DataFrame, unavailability: DataFrame, aircraft: DataFrame
) -> DataFrame:
    """All entries. See `flight_entries` for the flights and departures."""
    return (
        flight_entries(flights, departures, aircraft)
        .unionByName(report_entries(reports, aircraft))
        .unionByName(slot_entries(unavailability, aircraft))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table; where equal rows are stored once with their number, the sum of the numbers."""

    def rows(df: DataFrame) -> Column:
        return F.coalesce(F.sum("copies"), F.lit(0)) if "copies" in df.columns else F.count("*")

    counts = [df.agg(rows(df).alias("row_count")).select(F.lit(n).alias("item"), "*") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def dq_summary(audit: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage (`tables`, by label) and corrections or drops per rule."""
    rules = audit.groupBy(F.concat(F.lit("rule "), "rule").alias("item")).agg(F.sum("copies").alias("row_count"))
    return row_counts(tables).unionByName(rules)
