"""The same KPIs straight from the source tables, without any repair.

They differ from the warehouse KPIs on purpose: aircraft of other makers form groups named after
their registration, days out of service are fractional, aircraft with slots but no flights count,
and whole-number ratios are truncated.

Source rows are reduced to one row per aircraft and year before the manufacturer is looked up. An
aircraft has one row per year then, so the distinct aircraft are a plain count.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.functions import false_if_null, micros_between, ratio, round_places
from hangarline.functions.expressions import MICROS_PER_DAY, MICROS_PER_HOUR, MICROS_PER_MINUTE
from hangarline.operators.extract import aircraft_lookup
from hangarline.operators.facts import DELAY_THRESHOLD_MINUTES
from hangarline.plans.kpis import DAYS_PER_YEAR, reporting_rates

# Makers that form a group; in this order of precedence.
MAKERS = ("Airbus", "Boeing")

SUMS = (
    "flight_micros",
    "flight_cycles",
    "cancellations",
    "delays",
    "delay_micros",
    "scheduled_micros",
    "unscheduled_micros",
)


def _zeros(*names: str) -> list[Column]:
    return [F.lit(0).alias(name) for name in names]


def _flight_rows(flights: DataFrame) -> DataFrame:
    cancelled = false_if_null(F.col("cancelled"))
    late = micros_between(F.col("scheduledarrival"), F.col("actualarrival"))
    delayed = ~cancelled & false_if_null(late > DELAY_THRESHOLD_MINUTES * MICROS_PER_MINUTE)
    flown = micros_between(F.col("actualdeparture"), F.col("actualarrival"))
    return flights.select(
        F.col("aircraftregistration").alias("aircraft_id"),
        F.year("scheduleddeparture").alias("year"),
        F.when(cancelled, 0).otherwise(flown).alias("flight_micros"),
        (~cancelled).cast("int").alias("flight_cycles"),
        cancelled.cast("int").alias("cancellations"),
        delayed.cast("int").alias("delays"),
        F.when(delayed, late).otherwise(0).alias("delay_micros"),
        *_zeros("scheduled_micros", "unscheduled_micros"),
    )


def _slot_rows(maintenance: DataFrame) -> DataFrame:
    programmed = false_if_null(F.col("programmed"))
    length = micros_between(F.col("scheduleddeparture"), F.col("scheduledarrival"))
    return maintenance.select(
        F.col("aircraftregistration").alias("aircraft_id"),
        F.year("scheduleddeparture").alias("year"),
        *_zeros("flight_micros", "flight_cycles", "cancellations", "delays", "delay_micros"),
        F.when(programmed, length).otherwise(0).alias("scheduled_micros"),
        F.when(programmed, 0).otherwise(length).alias("unscheduled_micros"),
    )


def atomic_rows(flights: DataFrame, maintenance: DataFrame) -> DataFrame:
    """One row per flight and per slot, with zeros for the measures of the other kind."""
    return _flight_rows(flights).unionByName(_slot_rows(maintenance))


def makers(lookup: DataFrame) -> DataFrame:
    """One maker per registration of the known makers; the first in alphabetical order wins."""
    return (
        aircraft_lookup(lookup)
        .where(F.col("manufacturer").isin(*MAKERS))
        .groupBy("aircraft_id")
        .agg(F.min("manufacturer").alias("maker"))
    )


def with_raw_manufacturer(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Maker of each row's aircraft, or else the registration itself."""
    return (
        rows.join(makers(lookup), "aircraft_id", "left")
        .withColumn("manufacturer", F.coalesce("maker", "aircraft_id"))
        .drop("maker")
    )


def atomic(flights: DataFrame, maintenance: DataFrame, lookup: DataFrame) -> DataFrame:
    """The rows behind the raw utilization KPIs, in hours, minutes and days."""
    return with_raw_manufacturer(atomic_rows(flights, maintenance), lookup).select(
        "aircraft_id",
        "manufacturer",
        "year",
        (F.col("flight_micros") / MICROS_PER_HOUR).alias("flight_hours"),
        "flight_cycles",
        "cancellations",
        "delays",
        (F.col("delay_micros") / MICROS_PER_MINUTE).alias("delayed_minutes"),
        (F.col("scheduled_micros") / MICROS_PER_DAY).alias("scheduled_out_of_service"),
        (F.col("unscheduled_micros") / MICROS_PER_DAY).alias("unscheduled_out_of_service"),
    )


def _reduced(rows: DataFrame, names: tuple[str, ...], lookup: DataFrame, *more_keys: str) -> DataFrame:
    """Sums per (aircraft, year), then per (manufacturer, year), with the number of aircraft."""
    per_aircraft = rows.groupBy("aircraft_id", "year", *more_keys).agg(*[F.sum(n).alias(n) for n in names])
    return (
        with_raw_manufacturer(per_aircraft, lookup)
        .groupBy("manufacturer", "year", *more_keys)
        .agg(F.count("aircraft_id").alias("fleet"), *[F.sum(n).alias(n) for n in names])
    )


def utilization(flights: DataFrame, maintenance: DataFrame, lookup: DataFrame) -> DataFrame:
    totals = _reduced(atomic_rows(flights, maintenance), SUMS, lookup)

    def per_aircraft(value: Column) -> Column:
        return round_places(ratio(value, F.col("fleet")), 2)

    scheduled = F.col("scheduled_micros") / MICROS_PER_DAY
    unscheduled = F.col("unscheduled_micros") / MICROS_PER_DAY
    hours, minutes = F.col("flight_micros") / MICROS_PER_HOUR, F.col("delay_micros") / MICROS_PER_MINUTE
    rounded = totals.select(
        "*",
        per_aircraft(hours).alias("fh"),
        # Whole numbers divided by whole numbers: the source database truncates.
        F.expr("flight_cycles div nullif(fleet, 0L)").alias("take_offs"),
        per_aircraft(scheduled).alias("adoss"),
        per_aircraft(unscheduled).alias("adosu"),
        per_aircraft(scheduled + unscheduled).alias("ados"),
    )
    in_service = F.lit(DAYS_PER_YEAR) - F.col("ados")
    cycles = F.col("flight_cycles")
    return rounded.select(
        "manufacturer",
        "year",
        "fh",
        "take_offs",
        "adoss",
        "adosu",
        "ados",
        in_service.alias("adis"),
        round_places(ratio(F.col("fh"), in_service * 24), 2).alias("du"),
        round_places(ratio(F.col("take_offs"), in_service), 2).alias("dc"),
        (100 * round_places(ratio(F.col("delays"), cycles), 4)).alias("dyr"),
        (100 * round_places(ratio(F.col("cancellations"), cycles), 4)).alias("cnr"),
        F.expr("100 - (100 * (delays + cancellations)) div nullif(flight_cycles, 0L)").alias("tdr"),
        (100 * round_places(ratio(minutes, F.col("delays")), 2)).alias("avg_delay_x100"),
    )


def reporting(
    flights: DataFrame, postflight: DataFrame, lookup: DataFrame, per_role: bool = False
) -> DataFrame:
    flown = _reduced(_flight_rows(flights), ("flight_micros", "flight_cycles"), lookup).select(
        "manufacturer", "year", (F.col("flight_micros") / MICROS_PER_HOUR).alias("flight_hours"), "flight_cycles"
    )
    written = postflight.select(
        F.col("aircraftregistration").alias("aircraft_id"),
        F.year("reportingdate").alias("year"),
        F.col("reporteurclass").alias("role"),
        F.lit(1).alias("report_count"),
    )
    role = ("role",) if per_role else ()
    counts = _reduced(written, ("report_count",), lookup, *role).drop("fleet")
    return reporting_rates(counts, flown)


def upper_roles(rates: DataFrame) -> DataFrame:
    """Roles spelled as in the warehouse, to compare the two."""
    return rates.withColumn("role", F.upper("role"))
