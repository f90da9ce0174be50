"""Source tables to a published warehouse."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangarline import schemas
from hangarline.operators import audit, checks, dimensions, extract, facts, quality
from hangarline.sources.tables import SourceTables
from hangarline.warehouse import Warehouse


def dimension_tables(src: SourceTables) -> dict[str, DataFrame]:
    dates = dimensions.dates(extract.calendar(src))
    return {
        "aircraft": dimensions.aircraft_from_lookup(src.aircraft_lookup),
        "date": dates,
        "month": dimensions.months(dates),
    }


def repaired_flights(src: SourceTables) -> DataFrame:
    return quality.repair_swapped_times(extract.flights(src.flights))


def report_rows(src: SourceTables) -> DataFrame:
    return facts.all_reports(
        extract.postflight_reports(src.postflightreports), extract.technical_logbook(src.technicallogbookorders)
    )


def loadable(candidate: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Fact rows on known aircraft. Their days and months come from tables the calendar covers."""
    return candidate.join(aircraft.select("aircraft_id"), "aircraft_id", "left_semi")


def loadable_reports(src: SourceTables, aircraft: DataFrame) -> DataFrame:
    """Reports as they are loaded, without ids, which only the table needs."""
    return facts.loadable_reports(
        extract.postflight_reports(src.postflightreports),
        extract.technical_logbook(src.technicallogbookorders),
        aircraft,
        extract.personnel(src.personnel),
    )


def fact_tables(src: SourceTables, aircraft: DataFrame) -> dict[str, DataFrame]:
    """The three facts as they would be loaded, computed from the source."""
    return {
        "flights": loadable(facts.flights_fact(extract.flights(src.flights)), aircraft),
        "unavailability": loadable(facts.unavailability_fact(extract.maintenance(src.maintenance)), aircraft),
        "reports": facts.expanded_reports(facts.report_id_ranges(loadable_reports(src, aircraft))),
    }


def flight_decisions(flights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flights after BR-23, counted, and what BR-21 decides for them: what the audit of flights needs, from one scan."""
    counted = quality.counted_flights(flights)
    totals = {"uncontested": "IF(contested, 0, copies)"}
    return counted, quality.ordered_departures(counted, totals, apart=("copies", "times_swapped"))


def stages(
    flights: DataFrame,
    slots: DataFrame,
    reports: DataFrame,
    personnel: DataFrame,
    universe: DataFrame,
    calendar: DataFrame,
    dates: DataFrame,
    aircraft: DataFrame,
) -> dict[str, DataFrame]:
    """What the summary counts, by label: what the sources hold, and what is left after each step that drops rows."""

    def of(source: str) -> DataFrame:
        return reports.where(F.col("source") == source)

    return {
        "source flights": flights,
        "source maintenance": slots,
        "source technical logbook": of("technicallogbook"),
        "source post-flight reports": of("postflightreport"),
        "source personnel": personnel,
        "source aircraft": universe,
        "source dates": calendar,
        "aircraft": aircraft,
        "dates": dates,
        "complete slots": facts.complete_slots(slots.drop("end_date")),
        "known reports": quality.with_known_aircraft(reports, aircraft),
    }


#: Tables of a run that later steps of the same build read, and nobody else.
INTERMEDIATES = (
    "calendar",
    "flights_repaired",
    "flight_departures",
    "slots",
    "report_groups",
    "personnel",
    "aircraft_universe",
    "report_ranges",
    "unavailability_monthly",
)


def publish(warehouse: Warehouse) -> None:
    """Publishes a run if keys, required values and references hold in all its tables, else raises."""
    checks.require_integrity(warehouse.tables())
    warehouse.publish()


def run(spark: SparkSession, src: SourceTables, root: str, keep_intermediates: bool = False) -> Warehouse:
    """Full rebuild. Publishes only if everything was written and is sound; an error leaves the old run in place.

    Each source table is read once: what is extracted from it is written, and everything else, counts of source rows
    included, comes from what was written. A task that is repeated writes its part once, so counts hold whatever
    fails on the way. Dimensions are read back after they are written, so later joins know their true size. The outcome
    of BR-21 feeds the fact and the audit; it is stored instead of being computed twice, which also means that a lost
    executor never repeats the overlap search for a later step. Steps that do not depend on each other are submitted
    together, so that the end of one does not leave the cluster idle.
    """
    warehouse = Warehouse.new_run(spark, root)
    # Sources that cannot be opened and conflicting aircraft are found before the long steps start.
    extracted = {
        "flights_repaired": repaired_flights(src),
        "slots": extract.slots(src.maintenance),
        "report_groups": facts.counted_reports(report_rows(src)),
        "personnel": extract.personnel(src.personnel),
    }
    aircraft = warehouse.write("aircraft", dimensions.aircraft_from_lookup(src.aircraft_lookup))
    checks.require_unique_key(aircraft, schemas.AIRCRAFT)

    with ThreadPoolExecutor(max_workers=4) as pool:
        writing = {name: pool.submit(warehouse.write, name, rows) for name, rows in extracted.items()}
        flights, slots, reports, personnel = (writing[name].result() for name in extracted)

        def write_calendar() -> tuple[DataFrame, DataFrame]:
            days = warehouse.write("calendar", extract.extracted_calendar(flights, slots, reports))
            dates = warehouse.write("date", dimensions.dates(days))
            warehouse.write("month", dimensions.months(dates))
            return days, dates

        def write_reports() -> None:
            loadable = facts.attributed_reports(
                quality.with_known_aircraft(reports, aircraft).dropna(subset=facts.REPORT_REQUIRED), personnel
            )
            ranges = warehouse.write("report_ranges", facts.report_id_ranges(loadable))
            warehouse.write("reports", facts.expanded_reports(ranges))

        def write_universe() -> DataFrame:
            postflight = reports.where("source = 'postflightreport'")
            seen = [rows.select("aircraft_id") for rows in (flights, slots, postflight)]
            seen += [table.select("aircraftregistration") for table in (src.workorders, src.maintenanceevents)]
            return warehouse.write("aircraft_universe", extract.aircraft_seen(src.aircraft_lookup, seen))

        calendar = pool.submit(write_calendar)
        numbering = pool.submit(write_reports)
        seeing = pool.submit(write_universe)
        measured = facts.measured_departures(flights.drop("times_swapped"))
        departures = warehouse.write("flight_departures", measured)
        downtime = warehouse.write("unavailability_monthly", facts.unavailability_fact(slots.drop("end_date")))
        entries = audit.dq_audit(flights.withColumn("copies", F.lit(1)), departures, reports, downtime, aircraft)
        auditing = pool.submit(warehouse.write, "dq_audit", entries)
        warehouse.write("flights", loadable(facts.daily_flights(departures), aircraft))
        warehouse.write("unavailability", loadable(downtime, aircraft))
        numbering.result()
        counted = stages(flights, slots, reports, personnel, seeing.result(), *calendar.result(), aircraft)
        counted |= {f"published {name}": table for name, table in warehouse.tables().items()}
        warehouse.write("dq_summary", audit.dq_summary(auditing.result(), counted))
    publish(warehouse)
    if not keep_intermediates:
        for name in INTERMEDIATES:
            warehouse.remove(name)
    return warehouse
