"""KPIs per manufacturer and year from the warehouse tables.

Facts are reduced to one row per aircraft and year before they meet the aircraft dimension, so the
joins see neither raw volumes nor the skew of single aircraft. No join is forced to broadcast: Spark
does so when the table's size, known from its files or measured at run time, allows it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.functions import ratio, round_places
from hangarline.functions.expressions import MICROS_PER_HOUR, MICROS_PER_MINUTE
from hangarline.operators.facts import POSTFLIGHT
from hangarline.schemas import FLIGHTS, year_of

DAYS_PER_YEAR = 365


#: Stored measures that are fractions of whole microseconds, and how many of these they stand for.
MICROS = {"flight_hours": MICROS_PER_HOUR, "delay_minutes": MICROS_PER_MINUTE}


def _exact(measure: str) -> Column:
    """A measure to be summed without loss: fractions as the whole microseconds they were made from.

    Sums of doubles depend on the order of the rows, sums of whole numbers do not. The stored double gives back the
    microseconds exactly up to 600,000 hours a row.
    """
    return F.rint(F.col(measure) * MICROS[measure]).cast("bigint") if measure in MICROS else F.col(measure)


def _in_units(measure: str, total: Column) -> Column:
    return total / MICROS[measure] if measure in MICROS else total


def _year_totals(flights: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Exact sums per aircraft and year."""
    return flights.groupBy("aircraft_id", year_of(flights).alias("year")).agg(*[F.sum(_exact(m)).alias(m) for m in measures])


def flights_per_aircraft_year(flights: DataFrame) -> DataFrame:
    totals = _year_totals(flights, FLIGHTS.measures)
    return totals.select("aircraft_id", "year", *[_in_units(m, F.col(m)).alias(m) for m in FLIGHTS.measures])


def unavailability_per_aircraft_year(unavailability: DataFrame) -> DataFrame:
    def days_of(kind: str) -> Column:
        return F.sum(F.when(F.col("type") == kind, F.col("days")).otherwise(0.0))

    return unavailability.groupBy("aircraft_id", year_of(unavailability).alias("year")).agg(
        days_of("SCHEDULED").alias("scheduled_days"),
        days_of("UNSCHEDULED").alias("unscheduled_days"),
        F.sum("days").alias("total_days"),
    )


def aircraft_year(flights: DataFrame, unavailability: DataFrame) -> DataFrame:
    """Aircraft with flights in a year, with their days out of service (none: 0)."""
    return _with_downtime(flights_per_aircraft_year(flights), unavailability)


def _with_downtime(per_year: DataFrame, unavailability: DataFrame) -> DataFrame:
    days = ("scheduled_days", "unscheduled_days", "total_days")
    joined = per_year.join(unavailability_per_aircraft_year(unavailability), ["aircraft_id", "year"], "left")
    return joined.withColumns({d: F.coalesce(F.col(d), F.lit(0.0)) for d in days})


def with_manufacturer(per_aircraft: DataFrame, aircraft: DataFrame) -> DataFrame:
    return per_aircraft.join(aircraft.select("aircraft_id", "manufacturer"), "aircraft_id")


def flights_with_aircraft(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Daily flights with the model and manufacturer of the aircraft."""
    return flights.join(aircraft, "aircraft_id")


def utilization(flights: DataFrame, unavailability: DataFrame, aircraft: DataFrame) -> DataFrame:
    per_year = _with_downtime(_year_totals(flights, FLIGHTS.measures), unavailability)
    totals = (
        with_manufacturer(per_year, aircraft)
        .groupBy("manufacturer", "year")
        .agg(
            (_in_units("flight_hours", F.sum("flight_hours")) / F.count("*")).alias("hours"),
            F.avg("takeoff").alias("cycles"),
            F.avg("scheduled_days").alias("scheduled"),
            F.avg("unscheduled_days").alias("unscheduled"),
            F.avg("total_days").alias("out_days"),
            *[_in_units(m, F.sum(m)).alias(m) for m in ("takeoff", "delays", "delay_minutes", "cancellations")],
        )
    )
    in_service = F.lit(DAYS_PER_YEAR) - F.col("out_days")
    takeoffs, delays, cancellations = F.col("takeoff"), F.col("delays"), F.col("cancellations")
    return totals.select(
        "manufacturer",
        "year",
        round_places(F.col("hours"), 2).alias("fh"),
        round_places(F.col("cycles"), 2).alias("take_offs"),
        round_places(F.col("scheduled"), 2).alias("adoss"),
        round_places(F.col("unscheduled"), 2).alias("adosu"),
        round_places(F.col("out_days"), 2).alias("ados"),
        round_places(in_service, 2).alias("adis"),
        round_places(ratio(F.col("hours"), in_service * 24), 2).alias("du"),
        round_places(ratio(F.col("cycles"), in_service), 2).alias("dc"),
        (100 * round_places(ratio(delays, takeoffs), 4)).alias("dyr"),
        (100 * round_places(ratio(cancellations, takeoffs), 4)).alias("cnr"),
        (100 - round_places(ratio(100 * (delays + cancellations), takeoffs), 2)).alias("tdr"),
        round_places(ratio(100 * F.col("delay_minutes"), delays), 2).alias("avg_delay_x100"),
    )


def flight_summary(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Hours and cycles per manufacturer and year."""
    return (
        with_manufacturer(_year_totals(flights, ("flight_hours", "takeoff")), aircraft)
        .groupBy("manufacturer", "year")
        .agg(_in_units("flight_hours", F.sum("flight_hours")).alias("flight_hours"), F.sum("takeoff").alias("flight_cycles"))
    )


def report_summary(reports: DataFrame, aircraft: DataFrame, per_role: bool = False) -> DataFrame:
    """Post-flight reports per manufacturer and year, and per role if asked."""
    role = ["role"] if per_role else []
    per_aircraft = (
        reports.where(F.col("source") == POSTFLIGHT)
        .select("aircraft_id", year_of(reports).alias("year"), F.col("reporter_class").alias("role"))
        .groupBy("aircraft_id", "year", *role)
        .agg(F.count("*").alias("report_count"))
    )
    return (
        with_manufacturer(per_aircraft, aircraft)
        .groupBy("manufacturer", "year", *role)
        .agg(F.sum("report_count").alias("report_count"))
    )


def reporting_rates(reports: DataFrame, flights: DataFrame) -> DataFrame:
    """Reports per 1000 flight hours and per 100 flights from the two summaries."""
    return reports.join(flights, ["manufacturer", "year"]).select(
        *[c for c in reports.columns if c != "report_count"],
        (1000 * round_places(ratio(F.col("report_count"), F.col("flight_hours")), 3)).alias("rrh"),
        (100 * round_places(ratio(F.col("report_count"), F.col("flight_cycles")), 2)).alias("rrc"),
    )


def reporting(reports: DataFrame, flights: DataFrame, aircraft: DataFrame, per_role: bool = False) -> DataFrame:
    return reporting_rates(report_summary(reports, aircraft, per_role), flight_summary(flights, aircraft))


def presented(result: DataFrame) -> DataFrame:
    """Reading order of a KPI table or of the calendar, which are small."""
    return result.orderBy(*[c for c in ("manufacturer", "date_id", "year", "role") if c in result.columns])
