"""Source rows to the columns the warehouse needs."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.functions import clean_code, false_if_null, month_key
from hangarline.sources.tables import SourceTables


def aircraft_lookup(lookup: DataFrame) -> DataFrame:
    return lookup.select(
        clean_code(F.col("aircraft_reg_code")).alias("aircraft_id"),
        F.col("aircraft_model").alias("model"),
        F.col("aircraft_manufacturer").alias("manufacturer"),
    )


def aircraft_universe(src: SourceTables) -> DataFrame:
    """Every registration seen in the lookup or in five operational tables, with lookup data if any."""
    tables = (src.flights, src.maintenance, src.workorders, src.postflightreports, src.maintenanceevents)
    return aircraft_seen(src.aircraft_lookup, [table.select("aircraftregistration") for table in tables])


def aircraft_seen(lookup_rows: DataFrame, registrations: list[DataFrame]) -> DataFrame:
    """Distinct registrations of the lookup and of frames of one column, with lookup data if any.

    The partial aggregation of `distinct` runs before the only shuffle, so each task sends each
    registration once.
    """
    lookup = aircraft_lookup(lookup_rows)
    seen = lookup.select("aircraft_id")
    for rows in registrations:
        seen = seen.unionByName(rows.select(clean_code(F.col(rows.columns[0])).alias("aircraft_id")))
    return seen.distinct().join(lookup, "aircraft_id", "left")


def manufacturer_aircraft(lookup: DataFrame) -> DataFrame:
    """Registrations per manufacturer, one row each."""
    return aircraft_lookup(lookup).select("manufacturer", "aircraft_id")


def _days(table: DataFrame, *columns: str) -> DataFrame:
    """All days in some columns of one table: one scan, reduced to distinct days per task."""
    return table.select(F.explode(F.array(*[F.to_date(c) for c in columns])).alias("date_id"))


def calendar(src: SourceTables) -> DataFrame:
    """Every day mentioned by flights, slots or reports, with its parts (unordered)."""
    return calendar_of(
        _days(src.flights, "actualdeparture", "actualarrival", "scheduleddeparture", "scheduledarrival"),
        _days(src.maintenance, "scheduleddeparture", "scheduledarrival"),
        _days(src.postflightreports, "reportingdate"),
        _days(src.technicallogbookorders, "reportingdate"),
    )


def extracted_calendar(flights: DataFrame, slots: DataFrame, reports: DataFrame) -> DataFrame:
    """The same days from extracted rows. Exchanging two times of a flight changes none of its days."""
    return calendar_of(
        _days(flights, "actualdeparture", "actualarrival", "date_id", "scheduledarrival"),
        _days(slots, "start_date", "end_date"),
        _days(reports, "date_id"),
    )


def calendar_of(*days: DataFrame) -> DataFrame:
    every = reduce(DataFrame.union, days).distinct()
    return every.select("date_id", *day_parts(F.col("date_id")))


def day_parts(day: Column) -> list[Column]:
    return [F.day(day).alias("day"), F.month(day).alias("month"), F.year(day).alias("year")]


def flights(table: DataFrame) -> DataFrame:
    """Flights belong to the day of their scheduled departure; an unknown cancellation is none."""
    return table.select(
        F.col("aircraftregistration").alias("aircraft_id"),
        F.to_date("scheduleddeparture").alias("date_id"),
        "actualdeparture",
        "actualarrival",
        "scheduledarrival",
        false_if_null(F.col("cancelled")).alias("cancelled"),
    )


def maintenance(table: DataFrame) -> DataFrame:
    """Slots with their length in whole days, booked to the month they start in."""
    return slots(table).drop("end_date")


def slots(table: DataFrame) -> DataFrame:
    """Slots as `maintenance` gives them, with the day they end on."""
    start, end = F.col("scheduleddeparture").try_cast("date"), F.col("scheduledarrival").try_cast("date")
    return table.select(
        F.col("aircraftregistration").alias("aircraft_id"),
        start.alias("start_date"),
        month_key(start).alias("month_id"),
        F.when(F.col("programmed"), "SCHEDULED").otherwise("UNSCHEDULED").alias("type"),
        F.date_diff(end, start).cast("double").alias("days"),
        end.alias("end_date"),
    )


def _reports(table: DataFrame, source: str) -> DataFrame:
    return table.select(
        F.col("reporteurid").alias("reporter_id"),
        F.col("aircraftregistration").alias("aircraft_id"),
        F.to_date("reportingdate").alias("date_id"),
        F.col("reporteurclass").alias("reporter_class"),
        F.lit("NULL").alias("airport"),
        F.lit(source).alias("source"),
    )


def technical_logbook(table: DataFrame) -> DataFrame:
    return _reports(table, "technicallogbook")


def postflight_reports(table: DataFrame) -> DataFrame:
    return _reports(table, "postflightreport")


def personnel(table: DataFrame) -> DataFrame:
    return table.select(F.col("reporteurid").alias("reporter_id"), "airport")
