from datetime import date, datetime

import pytest

from hangarline.functions.expressions import WHITESPACE
from hangarline.operators import dimensions, extract, facts
from hangarline.sources.tables import SourceTables

LOOKUP = "aircraft_reg_code string, manufacturer_serial_number string, aircraft_model string, aircraft_manufacturer string"


def test_aircraft_are_cleaned_and_incomplete_ones_left_out(spark):
    rows = [
        (" xy-aaa ", " A320 ", "Airbus\n"),
        ("XY-AAA", "A320", "Airbus"),
        ("XY-BBB", None, "Boeing"),
        (None, "A320", "Airbus"),
        ("XY-CCC", "B737", " Boeing"),
    ]
    frame = spark.createDataFrame(rows, "aircraft_id string, model string, manufacturer string")
    out = sorted(map(tuple, dimensions.aircraft(frame).collect()))
    assert out == [("XY-AAA", "A320", "Airbus"), ("XY-CCC", "B737", "Boeing")]


def test_every_kind_of_whitespace_is_stripped(spark):
    frame = spark.createDataFrame([(f"{c}xy-aaa{c}", "M", "Airbus") for c in WHITESPACE], "aircraft_id string, model string, manufacturer string")
    assert dimensions.aircraft(frame).count() == 1


def test_conflicting_lookup_entries_stay_visible(spark):
    rows = [("A", "A320", "Airbus"), ("A", "A321", "Airbus")]
    frame = spark.createDataFrame(rows, "aircraft_id string, model string, manufacturer string")
    assert dimensions.aircraft(frame).count() == 2


def test_invalid_days_are_left_out(spark):
    frame = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("no day",), (None,), ("2024-02-29",)], "date_id string")
    assert list(map(tuple, dimensions.dates(frame).collect())) == [(date(2024, 2, 29), 29, 2, 2024)]


def test_required_columns(spark):
    frame = spark.createDataFrame([(1,)], "x int")
    for operator in (dimensions.aircraft, dimensions.dates, facts.unavailability_fact):
        with pytest.raises(ValueError, match="missing required columns"):
            operator(frame)


def test_months_are_distinct_keys(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 31),), (date(2024, 12, 1),)], "date_id date")
    out = sorted(map(tuple, dimensions.months(dimensions.dates(frame)).collect()))
    assert out == [(202401, 1, 2024), (202412, 12, 2024)]


def maintenance(spark, rows):
    schema = "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz, programmed boolean"
    return spark.createDataFrame(rows, schema)


def test_slots_are_whole_days_in_their_start_month(spark):
    rows = [
        ("A", datetime(2024, 1, 31, 23), datetime(2024, 2, 2, 1), True),
        ("A", datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 23), None),
        ("A", datetime(2024, 1, 5), datetime(2024, 1, 4), False),
        ("A", None, datetime(2024, 1, 4), False),
        ("A", datetime(2024, 1, 4), None, False),
        (None, datetime(2024, 1, 4), datetime(2024, 1, 4), False),
    ]
    slots = extract.maintenance(maintenance(spark, rows))
    out = sorted(map(tuple, facts.unavailability_fact(slots).collect()))
    assert out == [("A", 202401, "SCHEDULED", 2.0), ("A", 202401, "UNSCHEDULED", -1.0)]


def test_unparseable_days_count_as_zero_and_types_are_upper_case(spark):
    schema = "aircraft_id string, start_date date, month_id int, type string, days string"
    day = date(2024, 1, 1)
    rows = [("A", day, 202401, "scheduled", "2.5"), ("A", day, 202401, "Scheduled", "many"), ("A", day, 202401, "x", None)]
    out = list(map(tuple, facts.unavailability_fact(spark.createDataFrame(rows, schema)).collect()))
    assert out == [("A", 202401, "SCHEDULED", 2.5)]


def source(spark):
    """Aircraft and days that occur in exactly one place each."""

    def registrations(*ids):
        return spark.createDataFrame([(i,) for i in ids], "aircraftregistration string")

    def reports(registration, day):
        schema = "reporteurid bigint, aircraftregistration string, reportingdate date, reporteurclass string"
        return spark.createDataFrame([(1, registration, day, "pirep")], schema)

    flights = spark.createDataFrame(
        [(" f1", datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3), datetime(2024, 1, 4), False)],
        "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz,"
        " actualdeparture timestamp_ntz, actualarrival timestamp_ntz, cancelled boolean",
    )
    return SourceTables.of(
        flights=flights,
        maintenance=maintenance(spark, [("M1", datetime(2024, 1, 5), datetime(2024, 1, 6), True)]),
        workorders=registrations("W1", "F1"),
        maintenanceevents=registrations("E1 ", None),
        postflightreports=reports("p1", date(2024, 1, 7)),
        technicallogbookorders=reports("T1", date(2024, 1, 8)),
        aircraft_lookup=spark.createDataFrame([(" f1 ", "1", "A320", "Airbus"), ("L1", "2", "B737", "Boeing")], LOOKUP),
        personnel=spark.createDataFrame([(1, "BCN")], "reporteurid bigint, airport string"),
    )


def test_universe_unites_five_tables_and_the_lookup(spark):
    out = {r.aircraft_id: r.model for r in extract.aircraft_universe(source(spark)).collect()}
    # The technical logbook (T1) is not one of the five.
    assert out == {"F1": "A320", "L1": "B737", "M1": None, "W1": None, "E1": None, "P1": None, None: None}


def test_lookup_alone_gives_the_same_aircraft_dimension(spark):
    src = source(spark)
    from_universe = dimensions.aircraft(extract.aircraft_universe(src)).collect()
    from_lookup = dimensions.aircraft_from_lookup(src.aircraft_lookup).collect()
    assert sorted(from_universe) == sorted(from_lookup) and len(from_lookup) == 2


def test_calendar_has_every_day_once(spark):
    out = sorted(r.date_id for r in extract.calendar(source(spark)).collect())
    assert out == [date(2024, 1, d) for d in range(1, 9)]


def test_registrations_per_manufacturer(spark):
    rows = extract.manufacturer_aircraft(source(spark).aircraft_lookup).collect()
    assert sorted(map(tuple, rows)) == [("Airbus", "F1"), ("Boeing", "L1")]
