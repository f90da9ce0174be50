"""DuckDB SQL for every query, written directly on the given tables.

The SQL follows the plain definition of each operator (one window per aircraft for BR-21, one global
row number for report ids, COUNT(DISTINCT) for the raw KPIs), not the way the Spark plans are split.
"""

from __future__ import annotations

import re

_PRELUDE = """
WITH fleet AS (SELECT count(*) AS n FROM supplier),
lookup_file AS (
  SELECT concat(' ac-', s_suppkey, ' ') AS aircraft_reg_code, concat('M', s_nationkey % 7) AS aircraft_model,
         CASE WHEN s_nationkey % 2 = 0 THEN 'Airbus' ELSE 'Boeing' END AS aircraft_manufacturer
  FROM supplier WHERE s_suppkey % 10 <> 9
),
lookup AS (
  SELECT upper(trim(aircraft_reg_code)) AS aircraft_id, aircraft_model AS model, aircraft_manufacturer AS manufacturer
  FROM lookup_file
),
l0 AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_quantity AS INT) * 30 AS q,
         CAST(round(l_discount * 100) AS INT) AS nd,
         l_shipdate + to_minutes(CAST((l_partkey % 24) * 60 AS BIGINT)) AS sd,
         (l_returnflag = 'R' AND l_orderkey % 10 = 0) AS cancelled
  FROM lineitem
),
l1 AS (
  SELECT *, sd + to_minutes(CAST(l_linenumber * 5 AS BIGINT)) AS d0,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              ELSE sd + to_minutes(CAST(l_linenumber * 5 + q + (nd - 5) * 10 AS BIGINT)) END AS a0
  FROM l0
),
s_flights AS (
  SELECT concat('AC-', l_suppkey) AS aircraftregistration, sd AS scheduleddeparture,
         sd + to_minutes(CAST(q AS BIGINT)) AS scheduledarrival,
         CASE WHEN l_orderkey % 50 = 0 AND a0 IS NOT NULL THEN a0 ELSE d0 END AS actualdeparture,
         CASE WHEN l_orderkey % 50 = 0 THEN d0 ELSE a0 END AS actualarrival, cancelled
  FROM l1
),
s_maintenance AS (
  SELECT concat('AC-', o_orderkey % (SELECT n FROM fleet)) AS aircraftregistration,
         o_orderdate + to_minutes(CAST((o_custkey % 24) * 60 AS BIGINT)) AS scheduleddeparture,
         o_orderdate + to_minutes(CAST((o_custkey % 24) * 60 + (o_custkey % 5) * 1440 + 300 AS BIGINT))
           AS scheduledarrival,
         o_orderpriority <> '1-URGENT' AS programmed
  FROM orders
),
s_workorders AS (
  SELECT concat(' ac-', o_custkey % (SELECT n FROM fleet)) AS aircraftregistration FROM orders
),
s_events AS (
  SELECT concat('AC-', user_id % ((SELECT n FROM fleet) + 5)) AS aircraftregistration
  FROM events
),
s_reports AS (
  SELECT user_id AS reporteurid, concat('AC-', event_id % (SELECT n FROM fleet)) AS aircraftregistration,
         DATE '1995-01-01' + CAST(event_id * 37 % 2400 AS INTEGER) AS reportingdate,
         CASE WHEN user_id % 2 = 0 THEN 'pirep' ELSE 'marep' END AS reporteurclass,
         CASE WHEN event_type IN ('click', 'view', 'error') THEN 'postflightreport' ELSE 'technicallogbook' END
           AS source
  FROM events
),
personnel AS (
  SELECT DISTINCT user_id AS reporter_id, concat('A', lpad(CAST(user_id % 20 AS VARCHAR), 2, '0')) AS airport
  FROM events WHERE user_id % 2 = 1
),
universe AS (
  SELECT DISTINCT upper(trim(aircraftregistration)) AS aircraft_id FROM (
    SELECT aircraft_reg_code AS aircraftregistration FROM lookup_file
    UNION ALL SELECT aircraftregistration FROM s_flights
    UNION ALL SELECT aircraftregistration FROM s_maintenance
    UNION ALL SELECT aircraftregistration FROM s_workorders
    UNION ALL SELECT aircraftregistration FROM s_events
    UNION ALL SELECT aircraftregistration FROM s_reports WHERE source = 'postflightreport')
),
universe_info AS (
  SELECT u.aircraft_id, l.model, l.manufacturer FROM universe u LEFT JOIN lookup l ON u.aircraft_id = l.aircraft_id
),
dim_aircraft AS (
  SELECT DISTINCT aircraft_id, trim(model) AS model, trim(manufacturer) AS manufacturer
  FROM universe_info WHERE aircraft_id IS NOT NULL AND model IS NOT NULL AND manufacturer IS NOT NULL
),
all_dates AS (
  SELECT CAST(actualdeparture AS DATE) AS date_id FROM s_flights
  UNION SELECT CAST(actualarrival AS DATE) FROM s_flights
  UNION SELECT CAST(scheduleddeparture AS DATE) FROM s_flights
  UNION SELECT CAST(scheduledarrival AS DATE) FROM s_flights
  UNION SELECT CAST(scheduleddeparture AS DATE) FROM s_maintenance
  UNION SELECT CAST(scheduledarrival AS DATE) FROM s_maintenance
  UNION SELECT reportingdate FROM s_reports
),
calendar AS (
  SELECT date_id, CAST(day(date_id) AS INTEGER) AS day, CAST(month(date_id) AS INTEGER) AS month,
         CAST(year(date_id) AS INTEGER) AS year
  FROM all_dates
),
dim_date AS (SELECT * FROM calendar WHERE date_id IS NOT NULL),
dim_month AS (SELECT DISTINCT year * 100 + month AS month_id, month, year FROM dim_date),
x_flights AS (
  SELECT aircraftregistration AS aircraft_id, CAST(scheduleddeparture AS DATE) AS date_id, actualdeparture,
         actualarrival, scheduledarrival, coalesce(cancelled, false) AS cancelled
  FROM s_flights
),
repaired AS (
  SELECT aircraft_id, date_id,
         CASE WHEN actualarrival < actualdeparture THEN actualarrival ELSE actualdeparture END AS actualdeparture,
         CASE WHEN actualarrival < actualdeparture THEN actualdeparture ELSE actualarrival END AS actualarrival,
         scheduledarrival, cancelled, coalesce(actualarrival < actualdeparture, false) AS times_swapped
  FROM x_flights
),
measured AS (
  SELECT *,
         CASE WHEN cancelled OR actualdeparture IS NULL OR actualarrival IS NULL THEN 0
              ELSE date_diff('microsecond', actualdeparture, actualarrival) END AS flight_micros,
         CASE WHEN cancelled THEN 0 ELSE 1 END AS takeoff,
         CASE WHEN NOT cancelled AND date_diff('microsecond', scheduledarrival, actualarrival) > 900000000
              THEN 1 ELSE 0 END AS delays,
         CASE WHEN NOT cancelled AND date_diff('microsecond', scheduledarrival, actualarrival) > 900000000
              THEN date_diff('microsecond', scheduledarrival, actualarrival) ELSE 0 END AS delay_micros,
         CASE WHEN cancelled THEN 1 ELSE 0 END AS cancellations,
         (NOT cancelled AND aircraft_id IS NOT NULL AND actualdeparture IS NOT NULL AND actualarrival IS NOT NULL)
           AS airborne
  FROM repaired
),
followed AS (
  SELECT *, lead(actualdeparture) OVER (
      PARTITION BY aircraft_id, airborne
      ORDER BY actualdeparture, actualarrival, scheduledarrival NULLS FIRST, date_id NULLS FIRST) AS next_departure
  FROM measured
),
marked AS (SELECT *, coalesce(airborne AND next_departure < actualarrival, false) AS overlapped FROM followed),
all_fact_flights AS (
  SELECT aircraft_id, date_id, CAST(sum(flight_micros) AS DOUBLE) / 3600000000.0::DOUBLE AS flight_hours,
         CAST(sum(takeoff) AS BIGINT) AS takeoff, CAST(sum(delays) AS BIGINT) AS delays,
         CAST(sum(delay_micros) AS DOUBLE) / 60000000.0::DOUBLE AS delay_minutes,
         CAST(sum(cancellations) AS BIGINT) AS cancellations
  FROM marked WHERE NOT overlapped AND aircraft_id IS NOT NULL AND date_id IS NOT NULL
  GROUP BY aircraft_id, date_id
),
fact_flights AS (SELECT * FROM all_fact_flights WHERE aircraft_id IN (SELECT aircraft_id FROM dim_aircraft)),
x_maintenance AS (
  SELECT aircraftregistration AS aircraft_id, CAST(scheduleddeparture AS DATE) AS start_date,
         CAST(year(scheduleddeparture) * 100 + month(scheduleddeparture) AS INTEGER) AS month_id,
         CASE WHEN programmed THEN 'SCHEDULED' ELSE 'UNSCHEDULED' END AS type,
         CAST(CAST(scheduledarrival AS DATE) - CAST(scheduleddeparture AS DATE) AS DOUBLE) AS days
  FROM s_maintenance
),
complete_slots AS (
  SELECT * FROM x_maintenance
  WHERE aircraft_id IS NOT NULL AND start_date IS NOT NULL AND month_id IS NOT NULL AND days IS NOT NULL
),
all_fact_unavailability AS (
  SELECT aircraft_id, month_id, upper(type) AS type, sum(days) AS days
  FROM complete_slots GROUP BY aircraft_id, month_id, upper(type)
),
fact_unavailability AS (
  SELECT * FROM all_fact_unavailability WHERE aircraft_id IN (SELECT aircraft_id FROM dim_aircraft)
),
x_reports AS (
  SELECT reporteurid AS reporter_id, aircraftregistration AS aircraft_id, reportingdate AS date_id,
         reporteurclass AS reporter_class, 'NULL' AS airport, source
  FROM s_reports
),
known_reports AS (
  SELECT * REPLACE (upper(trim(aircraft_id)) AS aircraft_id) FROM x_reports
  WHERE upper(trim(aircraft_id)) IN (SELECT aircraft_id FROM dim_aircraft)
),
unknown_reports AS (
  SELECT * REPLACE (upper(trim(aircraft_id)) AS aircraft_id) FROM x_reports
  WHERE upper(trim(aircraft_id)) NOT IN (SELECT aircraft_id FROM dim_aircraft)
),
attributed AS (
  SELECT r.aircraft_id, r.date_id, upper(r.reporter_class) AS reporter_class, p.airport, upper(r.source) AS source
  FROM known_reports r LEFT JOIN personnel p ON r.reporter_id = p.reporter_id
),
fact_reports AS (
  SELECT CAST(row_number() OVER (
             ORDER BY CASE WHEN source = 'POSTFLIGHTREPORT' THEN 0 ELSE 1 END, date_id, aircraft_id, reporter_class,
                      airport NULLS FIRST, source) - 1 AS BIGINT) AS report_id,
         aircraft_id, date_id, reporter_class, airport, source
  FROM attributed
),
flights_year AS (
  SELECT aircraft_id, CAST(year(date_id) AS INTEGER) AS year,
         sum(CAST(round(flight_hours * 3600000000.0::DOUBLE) AS BIGINT)) / 3600000000.0::DOUBLE AS flight_hours,
         CAST(sum(takeoff) AS BIGINT) AS takeoff, CAST(sum(delays) AS BIGINT) AS delays,
         sum(delay_minutes) AS delay_minutes, CAST(sum(cancellations) AS BIGINT) AS cancellations
  FROM fact_flights GROUP BY ALL
),
unavailability_year AS (
  SELECT aircraft_id, CAST(month_id // 100 AS INTEGER) AS year,
         coalesce(sum(days) FILTER (type = 'SCHEDULED'), 0) AS scheduled_days,
         coalesce(sum(days) FILTER (type = 'UNSCHEDULED'), 0) AS unscheduled_days, sum(days) AS total_days
  FROM fact_unavailability GROUP BY ALL
),
aircraft_year AS (
  SELECT * REPLACE (coalesce(scheduled_days, 0) AS scheduled_days, coalesce(unscheduled_days, 0) AS unscheduled_days,
                    coalesce(total_days, 0) AS total_days)
  FROM flights_year LEFT JOIN unavailability_year USING (aircraft_id, year)
),
fleet_year AS (
  SELECT manufacturer, year, avg(flight_hours) AS hours, avg(takeoff) AS starts, avg(scheduled_days) AS planned,
         avg(unscheduled_days) AS unplanned, avg(total_days) AS grounded, 365 - avg(total_days) AS available,
         sum(takeoff) AS takeoffs, sum(delays) AS delays, sum(cancellations) AS cancellations,
         sum(delay_minutes) AS minutes
  FROM aircraft_year JOIN dim_aircraft USING (aircraft_id) GROUP BY ALL
),
kpi_utilization AS (
  SELECT manufacturer, year, {r2:hours} AS fh, {r2:starts} AS take_offs, {r2:planned} AS adoss,
         {r2:unplanned} AS adosu, {r2:grounded} AS ados, {r2:available} AS adis,
         {r2:hours / nullif(available * 24, 0)} AS du, {r2:starts / nullif(available, 0)} AS dc,
         100 * {r4:delays / nullif(takeoffs, 0)} AS dyr, 100 * {r4:cancellations / nullif(takeoffs, 0)} AS cnr,
         100 - {r2:100 * (delays + cancellations) / nullif(takeoffs, 0)} AS tdr,
         {r2:100 * minutes / nullif(delays, 0)} AS avg_delay_x100
  FROM fleet_year
),
flight_summary AS (
  SELECT manufacturer, CAST(year(date_id) AS INTEGER) AS year,
         sum(CAST(round(flight_hours * 3600000000.0::DOUBLE) AS BIGINT)) / 3600000000.0::DOUBLE AS flight_hours,
         CAST(sum(takeoff) AS BIGINT) AS flight_cycles
  FROM fact_flights JOIN dim_aircraft USING (aircraft_id) GROUP BY ALL
),
report_summary_role AS (
  SELECT manufacturer, CAST(year(date_id) AS INTEGER) AS year, reporter_class AS role, count(*) AS report_count
  FROM fact_reports JOIN dim_aircraft USING (aircraft_id) WHERE source = 'POSTFLIGHTREPORT' GROUP BY ALL
),
report_summary AS (
  SELECT manufacturer, year, CAST(sum(report_count) AS BIGINT) AS report_count FROM report_summary_role GROUP BY ALL
),
kpi_reporting AS (SELECT manufacturer, year, {rates} FROM report_summary JOIN flight_summary USING (manufacturer, year)),
kpi_reporting_role AS (
  SELECT manufacturer, year, role, {rates} FROM report_summary_role JOIN flight_summary USING (manufacturer, year)
),
maker AS (
  SELECT aircraft_id AS registration, min(manufacturer) AS name
  FROM lookup WHERE manufacturer IN ('Airbus', 'Boeing') GROUP BY ALL
),
raw_flight AS (
  SELECT aircraftregistration AS aircraft_id, coalesce(name, aircraftregistration) AS manufacturer,
         CAST(year(scheduleddeparture) AS INTEGER) AS year, cancelled,
         date_diff('microsecond', actualdeparture, actualarrival) AS flown,
         coalesce(date_diff('microsecond', scheduledarrival, actualarrival), 0) AS late
  FROM s_flights LEFT JOIN maker ON registration = aircraftregistration
),
raw_slot AS (
  SELECT aircraftregistration AS aircraft_id, coalesce(name, aircraftregistration) AS manufacturer,
         CAST(year(scheduleddeparture) AS INTEGER) AS year, coalesce(programmed, false) AS programmed,
         date_diff('microsecond', scheduleddeparture, scheduledarrival) AS lasted
  FROM s_maintenance LEFT JOIN maker ON registration = aircraftregistration
),
atomic AS (
  SELECT aircraft_id, manufacturer, year, if(cancelled, 0, flown) AS flight_micros,
         CAST(NOT cancelled AS INTEGER) AS flight_cycles, CAST(cancelled AS INTEGER) AS cancellations,
         CAST(NOT cancelled AND late > 900000000 AS INTEGER) AS delays,
         if(NOT cancelled AND late > 900000000, late, 0) AS delay_micros, 0 AS scheduled_micros,
         0 AS unscheduled_micros
  FROM raw_flight
  UNION ALL BY NAME
  SELECT aircraft_id, manufacturer, year, 0 AS flight_micros, 0 AS flight_cycles, 0 AS cancellations, 0 AS delays,
         0 AS delay_micros, if(programmed, lasted, 0) AS scheduled_micros, if(programmed, 0, lasted) AS unscheduled_micros
  FROM raw_slot
),
raw_totals AS (
  SELECT manufacturer, year, nullif(count(DISTINCT aircraft_id), 0) AS fleet,
         sum(flight_micros) / 3600000000.0::DOUBLE AS hours, CAST(sum(flight_cycles) AS BIGINT) AS cycles,
         CAST(sum(cancellations) AS BIGINT) AS cancellations, CAST(sum(delays) AS BIGINT) AS delays,
         sum(delay_micros) / 60000000.0::DOUBLE AS minutes, sum(scheduled_micros) / 86400000000.0::DOUBLE AS planned,
         sum(unscheduled_micros) / 86400000000.0::DOUBLE AS unplanned
  FROM atomic GROUP BY ALL
),
raw_rounded AS (
  SELECT *, {r2:hours / fleet} AS fh, cycles // fleet AS take_offs, {r2:planned / fleet} AS adoss,
         {r2:unplanned / fleet} AS adosu, {r2:(planned + unplanned) / fleet} AS ados
  FROM raw_totals
),
raw_kpi_utilization AS (
  SELECT manufacturer, year, fh, take_offs, adoss, adosu, ados, 365 - ados AS adis,
         {r2:fh / nullif((365 - ados) * 24, 0)} AS du, {r2:take_offs / nullif(365 - ados, 0)} AS dc,
         100 * {r4:delays / nullif(cycles, 0)} AS dyr, 100 * {r4:cancellations / nullif(cycles, 0)} AS cnr,
         100 - (100 * (delays + cancellations)) // nullif(cycles, 0) AS tdr,
         100 * {r2:minutes / nullif(delays, 0)} AS avg_delay_x100
  FROM raw_rounded
),
raw_flown AS (
  SELECT manufacturer, year, sum(if(cancelled, 0, flown)) / 3600000000.0::DOUBLE AS flight_hours,
         count(*) FILTER (NOT cancelled) AS flight_cycles
  FROM raw_flight GROUP BY ALL
),
raw_written_role AS (
  SELECT coalesce(name, aircraftregistration) AS manufacturer, CAST(year(reportingdate) AS INTEGER) AS year,
         reporteurclass AS role, count(*) AS report_count
  FROM s_reports LEFT JOIN maker ON registration = aircraftregistration
  WHERE source = 'postflightreport' GROUP BY ALL
),
raw_written AS (SELECT manufacturer, year, sum(report_count) AS report_count FROM raw_written_role GROUP BY ALL),
raw_kpi_reporting AS (SELECT manufacturer, year, {rates} FROM raw_written JOIN raw_flown USING (manufacturer, year)),
raw_kpi_reporting_role AS (
  SELECT manufacturer, year, role, {rates} FROM raw_written_role JOIN raw_flown USING (manufacturer, year)
),
dq_audit AS (
  SELECT rule, aircraft_id, CAST(departure AS TIMESTAMP) AS departure, CAST(arrival AS TIMESTAMP) AS arrival, date_id,
         month_id, reporter_class, source, count(*) AS copies
  FROM (
    SELECT 'BR-23' AS rule, aircraft_id, actualdeparture AS departure, actualarrival AS arrival,
           CAST(NULL AS DATE) AS date_id, CAST(NULL AS INTEGER) AS month_id, CAST(NULL AS VARCHAR) AS reporter_class,
           CAST(NULL AS VARCHAR) AS source
    FROM x_flights WHERE actualarrival < actualdeparture
    UNION ALL SELECT 'BR-21', aircraft_id, actualdeparture, actualarrival, NULL, NULL, NULL, NULL
    FROM marked WHERE overlapped
    UNION ALL SELECT 'BR-UA', aircraft_id, NULL, NULL, date_id, NULL, reporter_class, source FROM unknown_reports
    UNION ALL SELECT 'FK-FLIGHTS', aircraft_id, NULL, NULL, date_id, NULL, NULL, NULL
    FROM all_fact_flights WHERE aircraft_id NOT IN (SELECT aircraft_id FROM dim_aircraft)
    UNION ALL SELECT 'FK-UNAVAILABILITY', aircraft_id, NULL, NULL, NULL, month_id, NULL, NULL
    FROM all_fact_unavailability WHERE aircraft_id NOT IN (SELECT aircraft_id FROM dim_aircraft))
  GROUP BY ALL
)
"""



def _expanded(sql: str) -> str:
    """Writes out `{r2:x}` and `{r4:x}` (x rounded to that many places) and `{rates}`."""
    sql = sql.replace(
        "{rates}",
        "1000 * {r3:report_count / nullif(flight_hours, 0)} AS rrh,"
        " 100 * {r2:report_count / nullif(flight_cycles, 0)} AS rrc",
    )
    return re.sub(r"\{r(\d):(.*?)\}", lambda m: f"(round(({m[2]}) * 1e{m[1]}) / 1e{m[1]})", sql)


PRELUDE = _expanded(_PRELUDE)

_KPIS_UTILIZATION = (
    "fh", "take_offs", "adoss", "adosu", "ados", "adis", "du", "dc", "dyr", "cnr", "tdr", "avg_delay_x100",
)
_KPIS_REPORTING = ("rrh", "rrc")


def _reconcile(warehouse: str, raw: str, kpis: tuple[str, ...], keys: tuple[str, ...]) -> str:
    columns = [f"coalesce(w.{k}, r.{k}) AS {k}" for k in keys]
    for k in kpis:
        columns += [
            f"CAST(w.{k} AS DOUBLE) AS {k}_wh",
            f"CAST(r.{k} AS DOUBLE) AS {k}_raw",
            f"CAST(w.{k} AS DOUBLE) - CAST(r.{k} AS DOUBLE) AS {k}_delta",
        ]
    on = " AND ".join(f"w.{k} = r.{k}" for k in keys)
    return f"SELECT {', '.join(columns)} FROM {warehouse} w FULL OUTER JOIN {raw} r ON {on}"


def _key_check(table: str, source: str, key: str, required: str) -> str:
    incomplete = " OR ".join(f"{c.strip()} IS NULL" for c in required.split(","))
    return f"""SELECT '{table}' AS table_name, (SELECT count(*) FROM {source}) AS row_count,
      (SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys,
      (SELECT count(*) FROM {source} WHERE {incomplete}) AS incomplete_rows"""


def _reference_check(table: str, source: str, column: str, reference: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{reference}' AS reference_table,
      count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_values
      FROM {source} WHERE {column} NOT IN (SELECT {column} FROM dim_{reference})"""


def _count(item: str, source: str) -> str:
    return f"SELECT '{item}' AS item, count(*) AS row_count FROM {source}"


_SIX = "aircraft_id, date_id, actualdeparture, actualarrival, scheduledarrival, cancelled"

SELECTS = {
    "src_aircraft_lookup": "SELECT * FROM lookup",
    "src_aircraft_universe": "SELECT * FROM universe_info",
    "src_dates": "SELECT * FROM calendar",
    "src_flights": "SELECT * FROM x_flights",
    "src_maintenance": "SELECT * FROM x_maintenance",
    "src_techlog": "SELECT * FROM x_reports WHERE source = 'technicallogbook'",
    "src_postflight": "SELECT * FROM x_reports WHERE source = 'postflightreport'",
    "src_personnel": "SELECT * FROM personnel",
    "src_manufacturer_aircraft": "SELECT manufacturer, aircraft_id FROM lookup",
    "br23_flagged": "SELECT * FROM x_flights WHERE actualarrival < actualdeparture",
    "br23_swapped": "SELECT * FROM repaired",
    "flight_measures": f"""SELECT {_SIX}, flight_micros / 3600000000.0::DOUBLE AS flight_hours, takeoff, delays,
        delay_micros / 60000000.0::DOUBLE AS delay_minutes, cancellations FROM measured""",
    "br21_flagged": f"SELECT {_SIX}, count(*) AS copies FROM marked WHERE overlapped GROUP BY ALL",
    "br21_kept": f"SELECT {_SIX} FROM marked WHERE NOT overlapped",
    "br_known_aircraft": "SELECT * FROM known_reports",
    "br_unknown_aircraft": "SELECT * FROM unknown_reports",
    "reports_union": "SELECT * FROM x_reports",
    "dim_aircraft": "SELECT * FROM dim_aircraft",
    "dim_date": "SELECT * FROM dim_date",
    "dim_month": "SELECT * FROM dim_month",
    "fact_flights": "SELECT * FROM fact_flights",
    "fact_unavailability": "SELECT * FROM fact_unavailability",
    "fact_reports": "SELECT * FROM fact_reports",
    "chk_primary_keys": " UNION ALL ".join(
        [
            _key_check("aircraft", "dim_aircraft", "aircraft_id", "aircraft_id"),
            _key_check("date", "dim_date", "date_id", "date_id"),
            _key_check("month", "dim_month", "month_id", "month_id, month, year"),
            _key_check("flights", "fact_flights", "aircraft_id, date_id", "aircraft_id, date_id"),
            _key_check(
                "unavailability", "fact_unavailability", "aircraft_id, month_id, type", "aircraft_id, month_id, type"
            ),
            _key_check("reports", "fact_reports", "report_id", "report_id, aircraft_id, date_id, reporter_class"),
        ]
    ),
    "chk_foreign_keys": " UNION ALL ".join(
        [
            _reference_check("flights", "all_fact_flights", "aircraft_id", "aircraft"),
            _reference_check("flights", "all_fact_flights", "date_id", "date"),
            _reference_check("unavailability", "all_fact_unavailability", "aircraft_id", "aircraft"),
            _reference_check("unavailability", "all_fact_unavailability", "month_id", "month"),
            _reference_check("reports", "x_reports", "aircraft_id", "aircraft"),
            _reference_check("reports", "x_reports", "date_id", "date"),
        ]
    ),
    "dq_audit": "SELECT * FROM dq_audit",
    "dq_summary": " UNION ALL ".join(
        [
            _count("source flights", "s_flights"),
            _count("source maintenance", "s_maintenance"),
            _count("source technical logbook", "s_reports WHERE source = 'technicallogbook'"),
            _count("source post-flight reports", "s_reports WHERE source = 'postflightreport'"),
            _count("source personnel", "personnel"),
            _count("source aircraft", "universe_info"),
            _count("source dates", "calendar"),
            _count("aircraft", "dim_aircraft"),
            _count("dates", "dim_date"),
            _count("complete slots", "complete_slots"),
            _count("known reports", "known_reports"),
            "SELECT concat('rule ', rule) AS item, CAST(sum(copies) AS BIGINT) AS row_count FROM dq_audit GROUP BY rule",
        ]
    ),
    "join_flights_aircraft": """SELECT f.*, a.model, a.manufacturer
        FROM all_fact_flights f JOIN dim_aircraft a ON f.aircraft_id = a.aircraft_id""",
    "agg_flights_aircraft_year": "SELECT * FROM flights_year",
    "agg_unavailability_aircraft_year": "SELECT * FROM unavailability_year",
    "agg_aircraft_year": "SELECT * FROM aircraft_year",
    "agg_flight_summary": "SELECT * FROM flight_summary",
    "agg_report_summary": "SELECT * FROM report_summary",
    "agg_report_summary_role": "SELECT * FROM report_summary_role",
    "kpi_utilization": "SELECT * FROM kpi_utilization",
    "kpi_reporting": "SELECT * FROM kpi_reporting",
    "kpi_reporting_role": "SELECT * FROM kpi_reporting_role",
    "raw_manufacturer": """SELECT aircraftregistration AS aircraft_id, scheduleddeparture,
        coalesce(name, aircraftregistration) AS manufacturer
        FROM s_flights LEFT JOIN maker ON registration = aircraftregistration""",
    "raw_atomic": """SELECT aircraft_id, manufacturer, year, flight_micros / 3600000000.0::DOUBLE AS flight_hours,
        flight_cycles, cancellations, delays, delay_micros / 60000000.0::DOUBLE AS delayed_minutes,
        scheduled_micros / 86400000000.0::DOUBLE AS scheduled_out_of_service,
        unscheduled_micros / 86400000000.0::DOUBLE AS unscheduled_out_of_service FROM atomic""",
    "raw_kpi_utilization": "SELECT * FROM raw_kpi_utilization",
    "raw_kpi_reporting": "SELECT * FROM raw_kpi_reporting",
    "raw_kpi_reporting_role": "SELECT * FROM raw_kpi_reporting_role",
    "reconcile_utilization": _reconcile(
        "kpi_utilization", "raw_kpi_utilization", _KPIS_UTILIZATION, ("manufacturer", "year")
    ),
    "reconcile_reporting": _reconcile(
        "kpi_reporting", "raw_kpi_reporting", _KPIS_REPORTING, ("manufacturer", "year")
    ),
    "reconcile_reporting_role": _reconcile(
        "kpi_reporting_role",
        "(SELECT * REPLACE (upper(role) AS role) FROM raw_kpi_reporting_role)",
        _KPIS_REPORTING,
        ("manufacturer", "year", "role"),
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: PRELUDE + select for name, select in SELECTS.items()}
