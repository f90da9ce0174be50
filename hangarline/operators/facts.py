"""Measures and the three facts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hangarline.functions import micros_sql
from hangarline.functions.expressions import MICROS_PER_HOUR, MICROS_PER_MINUTE
from hangarline.operators.quality import (
    ordered_departures,
    repair_swapped_times,
    with_known_aircraft,
)
from hangarline.schemas import require_columns

DELAY_THRESHOLD_MINUTES = 15
DELAY_MICROS = DELAY_THRESHOLD_MINUTES * MICROS_PER_MINUTE
POSTFLIGHT = "POSTFLIGHTREPORT"
REPORT_REQUIRED = ["date_id", "reporter_class"]


def flight_measures(flights: DataFrame) -> DataFrame:
    """Adds hours, take-off, delay and cancellation to every flight (after BR-23).

    A delay counts from more than 15 minutes behind the scheduled arrival, and then in full.
    """
    late = micros_sql("scheduledarrival", "actualarrival")
    delayed = f"NOT coalesce(cancelled, false) AND coalesce({late} > {DELAY_MICROS}, false)"
    hours = f"IF(coalesce(cancelled, false), 0, coalesce({micros_sql('actualdeparture', 'actualarrival')}, 0)) / {MICROS_PER_HOUR}L"
    return flights.selectExpr(
        "*",
        f"{hours} AS flight_hours",
        "IF(coalesce(cancelled, false), 0, 1) AS takeoff",
        f"IF({delayed}, 1, 0) AS delays",
        f"IF({delayed}, {late}, 0) / {MICROS_PER_MINUTE}L AS delay_minutes",
        "IF(coalesce(cancelled, false), 1, 0) AS cancellations",
    )


def measured_departures(flights: DataFrame) -> DataFrame:
    """`ordered_departures` with the total measures of the flights BR-21 cannot remove.

    After BR-23 those have no hours: they are cancelled, lack a time or have no duration.
    """
    flown = "NOT contested AND NOT coalesce(cancelled, false)"
    late = f"{flown} AND coalesce(lateness > {DELAY_MICROS}, false)"
    return ordered_departures(
        flights,
        {
            "takeoff": f"IF({flown}, 1, 0)",
            "delays": f"IF({late}, 1, 0)",
            "delay_micros": f"IF({late}, lateness, 0)",
            "cancellations": "IF(NOT contested AND coalesce(cancelled, false), 1, 0)",
            "uncontested": "IF(contested, 0, 1)",
        },
    )


def daily_flights(departures: DataFrame) -> DataFrame:
    """Kept flights to one row per aircraft and day, from the uncontested totals and the survivors.

    A day on which no flight is kept has no row, and neither have flights without aircraft or day.
    A survivor is not cancelled: it takes off, has hours, and is late if a time was scheduled.
    """
    kept = departures.where("(survives OR uncontested > 0) AND aircraft_id IS NOT NULL AND date_id IS NOT NULL")
    late = f"survives AND coalesce(late > {DELAY_MICROS}, false)"
    totals = {
        "flight_hours": f"sum(IF(survives, {micros_sql('departure', 'arrival')}, 0)) / {MICROS_PER_HOUR}L",
        "takeoff": "sum(takeoff + IF(survives, 1, 0))",
        "delays": f"sum(delays + IF({late}, 1, 0))",
        "delay_minutes": f"sum(delay_micros + IF({late}, late, 0)) / {MICROS_PER_MINUTE}L",
        "cancellations": "sum(cancellations)",
    }
    return kept.groupBy("aircraft_id", "date_id").agg(*[F.expr(f"{value} AS {name}") for name, value in totals.items()])


def flights_fact(flights: DataFrame) -> DataFrame:
    """BR-23, BR-21 and the roll-up; aircraft that are not in the dimension are still included."""
    return daily_flights(measured_departures(repair_swapped_times(flights).drop("times_swapped")))


SLOT_COLUMNS = ["aircraft_id", "start_date", "month_id", "type", "days"]


def complete_slots(slots: DataFrame) -> DataFrame:
    """Slots without any missing value."""
    require_columns(slots, SLOT_COLUMNS, "maintenance")
    return slots.dropna("any")


def unavailability_fact(slots: DataFrame) -> DataFrame:
    """Days out of service per aircraft, month and type."""
    return (
        complete_slots(slots)
        .select(
            "aircraft_id",
            "month_id",
            F.upper("type").alias("type"),
            F.coalesce(F.col("days").try_cast("double"), F.lit(0.0)).alias("days"),
        )
        .groupBy("aircraft_id", "month_id", "type")
        .agg(F.sum("days").alias("days"))
    )


def all_reports(postflight: DataFrame, logbook: DataFrame) -> DataFrame:
    return postflight.unionByName(logbook)


def reporter_airports(personnel: DataFrame) -> DataFrame:
    """One airport per reporter. A repeated reporter is an error, not a reason to repeat reports."""
    repeated = F.raise_error(F.concat(F.lit("personnel: repeated reporter "), F.col("reporter_id").cast("string")))
    return (
        personnel.where("reporter_id IS NOT NULL")
        .groupBy("reporter_id")
        .agg(F.when(F.count("*") > 1, repeated).otherwise(F.first("airport")).alias("airport"))
    )


def attributed_reports(known: DataFrame, personnel: DataFrame) -> DataFrame:
    """Airport of the reporter (pilots have none) and upper-case labels. `copies`, if there, stay with their row.

    Reports without a reporter match nobody; a key of their own spreads them over the tasks of the join.
    """
    own = F.concat(F.lit("none "), F.xxhash64("aircraft_id", "date_id", "reporter_class", "source").cast("string"))
    airports = reporter_airports(personnel).select(F.col("reporter_id").cast("string").alias("reporter_key"), "airport")
    return (
        known.drop("airport")
        .withColumn("reporter_key", F.coalesce(F.col("reporter_id").cast("string"), own))
        .join(airports, "reporter_key", "left")
        .select(
            "aircraft_id",
            "date_id",
            F.upper("reporter_class").alias("reporter_class"),
            "airport",
            F.upper("source").alias("source"),
            *(["copies"] if "copies" in known.columns else []),
        )
    )


def counted_reports(reports: DataFrame) -> DataFrame:
    """Distinct reports with their number, `copies`."""
    return reports.groupBy(*reports.columns).agg(F.count("*").alias("copies"))


def report_id_ranges(reports: DataFrame) -> DataFrame:
    """Equal reports as one row with `first_id` and their number, `copies`.

    The ids 0, 1, 2, ... go to post-flight reports first, then by day and the other columns. They depend
    on the rows alone, not on how they are partitioned, so a retried task repeats them. No window spans
    all reports:

    * reports that agree in every column are counted before the shuffle and share a range of ids;
    * the running total within a day is a window per feed and day, over distinct rows;
    * the total before a day is a running total over one row per feed and day, which the calendar
      bounds.
    """
    labels = ["aircraft_id", "reporter_class", "airport", "source"]
    day_keys = ["feed", "date_id"]
    groups = (
        reports.groupBy("date_id", *labels)
        .agg((F.sum("copies") if "copies" in reports.columns else F.count("*")).alias("copies"))
        .withColumn("feed", F.when(F.col("source") == POSTFLIGHT, 0).otherwise(1))
    )
    earlier_days = Window.orderBy(*day_keys).rowsBetween(Window.unboundedPreceding, -1)
    day_starts = (
        groups.groupBy(*day_keys)
        .agg(F.sum("copies").alias("day_total"))
        .select(*day_keys, F.coalesce(F.sum("day_total").over(earlier_days), F.lit(0)).alias("day_start"))
    )
    earlier = Window.partitionBy(*day_keys).orderBy(*labels).rowsBetween(Window.unboundedPreceding, -1)
    return (
        groups.withColumn("in_day", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .join(day_starts, day_keys)
        .select("date_id", *labels, "copies", F.expr("day_start + in_day").alias("first_id"))
    )


#: Ids that one task row expands at most.
RANGE_IDS = 100_000


def expanded_reports(ranges: DataFrame, piece_ids: int = RANGE_IDS) -> DataFrame:
    """One row per id. Every range is cut into pieces, and the pieces are dealt to tasks before they become rows."""
    piece = F.explode(F.expr(f"sequence(0L, (copies - 1) div {piece_ids})"))
    pieces = ranges.withColumn("piece", piece).withColumns(
        {
            "first_id": F.expr(f"first_id + piece * {piece_ids}"),
            "copies": F.expr(f"least(copies - piece * {piece_ids}, {piece_ids}L)"),
        }
    )
    return pieces.repartition("first_id").drop("piece").select(
        F.explode(F.expr("sequence(first_id, first_id + copies - 1)")).alias("report_id"),
        "aircraft_id",
        "date_id",
        "reporter_class",
        "airport",
        "source",
    )


def loadable_reports(
    postflight: DataFrame, logbook: DataFrame, aircraft: DataFrame, personnel: DataFrame
) -> DataFrame:
    """Both feeds, known aircraft only, with airport but without id."""
    known = with_known_aircraft(all_reports(postflight, logbook), aircraft)
    return attributed_reports(known.dropna(subset=REPORT_REQUIRED), personnel)


def reports_fact(postflight: DataFrame, logbook: DataFrame, aircraft: DataFrame, personnel: DataFrame) -> DataFrame:
    """Both feeds, known aircraft only, with airport and id."""
    return expanded_reports(report_id_ranges(loadable_reports(postflight, logbook, aircraft, personnel)))

