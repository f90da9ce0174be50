"""Every query by name, over the sample tables of a scale-factor folder.

All of them start from the source tables; nothing is cached or written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hangarline.operators import audit, checks, dimensions, extract, facts, quality
from hangarline.plans import kpis, pipeline, raw_kpis
from hangarline.plans.reconcile import reconcile
from hangarline.sources.sample_tables import sample_tables
from hangarline.sources.tables import SourceTables

Query = Callable[[SourceTables], DataFrame]


def _aircraft(src: SourceTables) -> DataFrame:
    return dimensions.aircraft_from_lookup(src.aircraft_lookup)


def _flights(src: SourceTables) -> DataFrame:
    return extract.flights(src.flights)


_repaired = pipeline.repaired_flights


def _removed(src: SourceTables) -> DataFrame:
    return quality.removed_flights(quality.flight_outcomes(_repaired(src).drop("times_swapped")))


def _flights_fact(src: SourceTables) -> DataFrame:
    return pipeline.loadable(facts.flights_fact(_flights(src)), _aircraft(src))


def _all_unavailability(src: SourceTables) -> DataFrame:
    return facts.unavailability_fact(extract.maintenance(src.maintenance))


def _unavailability_fact(src: SourceTables) -> DataFrame:
    return pipeline.loadable(_all_unavailability(src), _aircraft(src))


def _reports(src: SourceTables) -> DataFrame:
    return pipeline.loadable_reports(src, _aircraft(src))


def _reports_fact(src: SourceTables) -> DataFrame:
    return facts.expanded_reports(facts.report_id_ranges(_reports(src)))


def _dates(src: SourceTables) -> DataFrame:
    return dimensions.dates(extract.calendar(src))


def _warehouse_tables(src: SourceTables) -> dict[str, DataFrame]:
    return pipeline.dimension_tables(src) | pipeline.fact_tables(src, _aircraft(src))


def _candidate_tables(src: SourceTables) -> dict[str, DataFrame]:
    """Facts before unknown aircraft are taken out."""
    return pipeline.dimension_tables(src) | {
        "flights": facts.flights_fact(_flights(src)),
        "unavailability": _all_unavailability(src),
        "reports": pipeline.report_rows(src),
    }


def _dq_audit(src: SourceTables) -> DataFrame:
    counted, departures = pipeline.flight_decisions(_repaired(src))
    return audit.dq_audit(counted, departures, pipeline.report_rows(src), _all_unavailability(src), _aircraft(src))


def _dq_summary(src: SourceTables) -> DataFrame:
    stages = pipeline.stages(
        flights=src.flights,
        slots=extract.slots(src.maintenance),
        reports=pipeline.report_rows(src),
        personnel=src.personnel,
        universe=extract.aircraft_universe(src),
        calendar=extract.calendar(src),
        dates=_dates(src),
        aircraft=_aircraft(src),
    )
    return audit.dq_summary(_dq_audit(src), stages)


def _utilization(src: SourceTables) -> DataFrame:
    # The aircraft join drops unknown aircraft, so the facts need not be filtered before.
    return kpis.utilization(facts.flights_fact(_flights(src)), _all_unavailability(src), _aircraft(src))


def _reporting(src: SourceTables, per_role: bool = False) -> DataFrame:
    return kpis.reporting(_reports(src), facts.flights_fact(_flights(src)), _aircraft(src), per_role)


def _raw_utilization(src: SourceTables) -> DataFrame:
    return raw_kpis.utilization(src.flights, src.maintenance, src.aircraft_lookup)


def _raw_reporting(src: SourceTables, per_role: bool = False) -> DataFrame:
    return raw_kpis.reporting(src.flights, src.postflightreports, src.aircraft_lookup, per_role)


QUERIES: dict[str, Query] = {
    # Sources
    "src_aircraft_lookup": lambda s: extract.aircraft_lookup(s.aircraft_lookup),
    "src_aircraft_universe": extract.aircraft_universe,
    "src_dates": extract.calendar,
    "src_flights": _flights,
    "src_maintenance": lambda s: extract.maintenance(s.maintenance),
    "src_techlog": lambda s: extract.technical_logbook(s.technicallogbookorders),
    "src_postflight": lambda s: extract.postflight_reports(s.postflightreports),
    "src_personnel": lambda s: extract.personnel(s.personnel),
    "src_manufacturer_aircraft": lambda s: extract.manufacturer_aircraft(s.aircraft_lookup),
    # Quality rules
    "br23_flagged": lambda s: _flights(s).where("actualarrival < actualdeparture"),
    "br23_swapped": _repaired,
    "flight_measures": lambda s: facts.flight_measures(_repaired(s).drop("times_swapped")),
    "br21_flagged": _removed,
    "br21_kept": lambda s: quality.without_overlaps(_repaired(s).drop("times_swapped")),
    "br_known_aircraft": lambda s: quality.with_known_aircraft(pipeline.report_rows(s), _aircraft(s)),
    "br_unknown_aircraft": lambda s: quality.with_unknown_aircraft(pipeline.report_rows(s), _aircraft(s)),
    "reports_union": pipeline.report_rows,
    # Warehouse tables
    "dim_aircraft": _aircraft,
    "dim_date": _dates,
    "dim_month": lambda s: dimensions.months(_dates(s)),
    "fact_flights": _flights_fact,
    "fact_unavailability": _unavailability_fact,
    "fact_reports": _reports_fact,
    "chk_primary_keys": lambda s: checks.check_primary_keys(_warehouse_tables(s)),
    "chk_foreign_keys": lambda s: checks.check_references(_candidate_tables(s)),
    "dq_audit": _dq_audit,
    "dq_summary": _dq_summary,
    # Warehouse KPIs and their parts
    "join_flights_aircraft": lambda s: kpis.flights_with_aircraft(facts.flights_fact(_flights(s)), _aircraft(s)),
    "agg_flights_aircraft_year": lambda s: kpis.flights_per_aircraft_year(_flights_fact(s)),
    "agg_unavailability_aircraft_year": lambda s: kpis.unavailability_per_aircraft_year(_unavailability_fact(s)),
    "agg_aircraft_year": lambda s: kpis.aircraft_year(_flights_fact(s), _unavailability_fact(s)),
    "agg_flight_summary": lambda s: kpis.flight_summary(facts.flights_fact(_flights(s)), _aircraft(s)),
    "agg_report_summary": lambda s: kpis.report_summary(_reports(s), _aircraft(s)),
    "agg_report_summary_role": lambda s: kpis.report_summary(_reports(s), _aircraft(s), per_role=True),
    "kpi_utilization": _utilization,
    "kpi_reporting": _reporting,
    "kpi_reporting_role": lambda s: _reporting(s, per_role=True),
    # Raw KPIs and comparison
    "raw_manufacturer": lambda s: raw_kpis.with_raw_manufacturer(
        s.flights.selectExpr("aircraftregistration AS aircraft_id", "scheduleddeparture"), s.aircraft_lookup
    ),
    "raw_atomic": lambda s: raw_kpis.atomic(s.flights, s.maintenance, s.aircraft_lookup),
    "raw_kpi_utilization": _raw_utilization,
    "raw_kpi_reporting": _raw_reporting,
    "raw_kpi_reporting_role": lambda s: _raw_reporting(s, per_role=True),
    "reconcile_utilization": lambda s: reconcile(_utilization(s), _raw_utilization(s)),
    "reconcile_reporting": lambda s: reconcile(_reporting(s), _raw_reporting(s)),
    "reconcile_reporting_role": lambda s: reconcile(
        _reporting(s, per_role=True), raw_kpis.upper_roles(_raw_reporting(s, per_role=True))
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(sample_tables(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
