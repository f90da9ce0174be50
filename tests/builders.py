"""Small frames for the tests."""

from datetime import datetime

FLIGHT_SCHEMA = (
    "aircraft_id string, date_id date, actualdeparture timestamp_ntz, actualarrival timestamp_ntz,"
    " scheduledarrival timestamp_ntz, cancelled boolean"
)
REPORT_SCHEMA = (
    "reporter_id bigint, aircraft_id string, date_id date, reporter_class string, airport string, source string"
)


def at(text):
    """'08:00' on the first of January 2024, or a full time."""
    if text is None or isinstance(text, datetime):
        return text
    return datetime.fromisoformat(text if "-" in text else f"2024-01-01 {text}")


def flight(aircraft, departs, arrives, scheduled=None, cancelled=False, day=None):
    departs, arrives = at(departs), at(arrives)
    scheduled = at(scheduled) or arrives
    first_day = (departs or arrives or at("00:00")).date() if day is None else at(day).date()
    return (aircraft, first_day, departs, arrives, scheduled, cancelled)


def flights_frame(spark, rows):
    return spark.createDataFrame(rows, FLIGHT_SCHEMA)


def by_aircraft(df):
    return {row.aircraft_id: row for row in df.collect()}
