"""Data-quality rules. Each keeps the rows it repairs or removes, so that they can be audited."""

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangarline.functions import clean_code, micros_sql
from hangarline.schemas import require_columns

FLIGHT_COLUMNS = ["aircraft_id", "date_id", "actualdeparture", "actualarrival", "scheduledarrival", "cancelled"]


def repair_swapped_times(flights: DataFrame) -> DataFrame:
    """BR-23: a flight that arrives before it departs gets its two times exchanged."""
    require_columns(flights, ["actualdeparture", "actualarrival"], "flights")
    swapped = "coalesce(actualarrival < actualdeparture, false)"
    return flights.withColumns(
        {
            "times_swapped": F.expr(swapped),
            "actualdeparture": F.expr(f"IF({swapped}, actualarrival, actualdeparture)"),
            "actualarrival": F.expr(f"IF({swapped}, actualdeparture, actualarrival)"),
        }
    )


# Conditions on single flights, as SQL: a long expression is then one call into the session, not dozens.
AIRBORNE = (
    "(NOT coalesce(cancelled, false) AND aircraft_id IS NOT NULL AND actualdeparture IS NOT NULL"
    " AND actualarrival IS NOT NULL)"
)
CONTESTABLE = f"({AIRBORNE} AND actualarrival > actualdeparture)"


def airborne() -> Column:
    """Flights that take part in BR-21: not cancelled, with aircraft and both times known."""
    return F.expr(AIRBORNE)


def contestable() -> Column:
    """Flights BR-21 can remove: one without a duration ends before any later departure."""
    return F.expr(CONTESTABLE)


def ordered_departures(
    flights: DataFrame, totals: Mapping[str, str] | None = None, apart: Collection[str] = ()
) -> DataFrame:
    """BR-21 decided for the candidates of each aircraft, scheduled day and departure.

    Flights are ordered per aircraft by departure, arrival and then the remaining columns; one that is
    still in the air when its immediate successor departs is removed.

    Of flights that leave at the same moment only the last in that order can survive, since each of the
    others is followed by a departure before its arrival. Among flights that are equally late the last is
    simply the latest arrival, a maximum of one plain column that is aggregated by hash and combined before
    the shuffle. So it is enough to compare one candidate for each lateness with the next departure: any
    number of copies, or of flights with the same placeholder departure, shrinks to the few latenesses
    that flights of a day have.

    Candidates are not ordered by aircraft alone either, as one aircraft may hold a large share of all
    flights, but within (aircraft, span of departure). The last departure of a span is followed by the
    first of the next span that has any. Both ends of every span meet in a second window per aircraft,
    at most two rows per span, whatever the number of flights. Both parts start from the same exchange,
    so the flights are read and shuffled once.

    Columns of the result: `aircraft_id`, `date_id`, `departure` (NULL for flights outside the rule), the
    candidate's `arrival` (NULL if there is none), `late` (microseconds behind the scheduled arrival, if
    known), whether `cancelled` is `known`, the remaining columns as `more` if there are any, `survives`,
    and the sums `totals` over all flights of the row: SQL over the flights' columns and over `in_rule`,
    `contested` (whether BR-21 looks at a flight, and can remove it) and `lateness` (microseconds behind
    schedule). Columns named in `apart` serve the totals only.
    """
    require_columns(flights, FLIGHT_COLUMNS, "flights")
    more = [c for c in flights.columns if c not in FLIGHT_COLUMNS and c not in apart]
    latest = f"struct(actualarrival, {', '.join(more)})" if more else "actualarrival"
    # Flights outside the rule are not filtered out: pushed down to the scan, the filter would evaluate
    # the repair expressions of BR-23 many times. They collapse into one row per aircraft and day.
    departures = (
        flights.selectExpr(
            "*",
            f"{AIRBORNE} AS in_rule",
            f"{CONTESTABLE} AS contested",
            f"{micros_sql('scheduledarrival', 'actualarrival')} AS lateness",
        )
        .selectExpr(
            "*",
            "IF(in_rule, actualdeparture, NULL) AS departure",
            "IF(contested, lateness, NULL) AS late",
            "IF(contested, cancelled IS NOT NULL, NULL) AS known",
        )
        .groupBy("departure", "aircraft_id", "date_id", "late", "known")
        .agg(
            F.expr(f"max(IF(contested, {latest}, NULL)) AS best"),
            *[F.expr(f"sum({value}) AS {name}") for name, value in (totals or {}).items()],
        )
        .withColumn("span", F.to_date("departure"))
    )
    arrival = F.col("best.actualarrival") if more else F.col("best")
    # Of equal arrivals the later scheduled one is last: the one that is less late, a missing one first.
    order = (F.col("departure"), arrival, F.col("late").desc_nulls_first(), F.col("known"), F.col("date_id"))
    in_span = Window.partitionBy("aircraft_id", "span").orderBy(*order)
    followed = departures.withColumns(
        {"next_departure": F.lead("departure").over(in_span), "place": F.row_number().over(in_span)}
    )
    is_last = "(departure IS NOT NULL AND next_departure IS NULL)"
    inner = followed.where(f"NOT {is_last}")
    # Only ends of spans take part, and only the last ones need their successor.
    ends = followed.where(f"{is_last} OR (place = 1 AND departure IS NOT NULL)")
    of_aircraft = Window.partitionBy("aircraft_id").orderBy(*order)
    ends = ends.withColumn("following", F.lead("departure").over(of_aircraft)).where("next_departure IS NULL")
    rows = inner.unionByName(ends.withColumn("next_departure", F.col("following")).drop("following"))
    in_time = F.coalesce(F.col("next_departure") >= arrival, F.lit(True))
    survives = F.col("best").isNotNull() & in_time
    columns = ["aircraft_id", "date_id", "departure", arrival.alias("arrival"), "late", "known"]
    columns += [F.struct(*[f"best.{c}" for c in more]).alias("more")] if more else []
    return rows.select(*columns, survives.alias("survives"), *(totals or {}))


def surviving_flights(departures: DataFrame) -> DataFrame:
    """The contestable flights BR-21 keeps."""
    return departures.where("survives").select(
        "aircraft_id",
        "date_id",
        F.col("departure").alias("actualdeparture"),
        F.col("arrival").alias("actualarrival"),
        F.expr("timestampadd(MICROSECOND, -late, arrival)").alias("scheduledarrival"),
        F.when(F.col("known"), F.lit(False)).alias("cancelled"),
        *(["more.*"] if "more" in departures.columns else []),
    )


def without_overlaps(flights: DataFrame) -> DataFrame:
    """Every flight BR-21 keeps. Flights it cannot remove are not shuffled."""
    survivors = surviving_flights(ordered_departures(flights))
    return flights.where(~contestable()).unionByName(survivors.select(flights.columns))


def counted_flights(flights: DataFrame) -> DataFrame:
    """Distinct flights with their number, `copies`."""
    return flights.groupBy(*flights.columns).agg(F.count("*").alias("copies"))


def flight_outcomes(flights: DataFrame) -> DataFrame:
    """Distinct flights with their number, `copies`, and how many of these BR-21 removes, `removed`.

    Equal flights are counted once, and the search for survivors starts from the counted rows, so that both
    share one exchange.
    """
    counted = counted_flights(flights)
    # The total keeps the counts in this branch: without them it would be another aggregate and another scan.
    departures = ordered_departures(counted, {"flights": "copies"}, apart=("copies",)).where("flights > 0")
    survivors = surviving_flights(departures).select(*flights.columns, F.lit(0).cast("long").alias("copies"))
    both = counted.withColumn("kept", F.lit(0)).unionByName(survivors.withColumn("kept", F.lit(1)))
    removed = F.when(contestable(), F.col("copies") - F.col("kept")).otherwise(0)
    return (
        both.groupBy(*flights.columns)
        .agg(F.max("copies").alias("copies"), F.sum("kept").alias("kept"))
        .select(*flights.columns, "copies", removed.alias("removed"))
    )


def removed_flights(outcomes: DataFrame) -> DataFrame:
    """The flights BR-21 removes, equal rows counted as `copies`."""
    flights = [c for c in outcomes.columns if c not in ("copies", "removed")]
    return outcomes.where("removed > 0").select(*flights, F.col("removed").alias("copies"))


def with_known_aircraft(rows: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Rows whose (normalised) aircraft is in the aircraft dimension."""
    return normalised(rows).join(_registrations(aircraft), "aircraft_id", "left_semi")


def with_unknown_aircraft(rows: DataFrame, aircraft: DataFrame) -> DataFrame:
    """The complement, including rows without an aircraft."""
    return normalised(rows).join(_registrations(aircraft), "aircraft_id", "left_anti")


def normalised(rows: DataFrame) -> DataFrame:
    """Rows with their registration as the aircraft dimension spells it."""
    return rows.withColumn("aircraft_id", clean_code(F.col("aircraft_id")))


def _registrations(aircraft: DataFrame) -> DataFrame:
    return normalised(aircraft.select("aircraft_id"))
