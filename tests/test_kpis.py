"""KPI formulas on hand-made facts, warehouse and raw."""

from datetime import date, datetime

import pytest

from hangarline import schemas
from hangarline.operators import checks
from hangarline.plans import kpis, raw_kpis
from hangarline.plans.reconcile import reconcile


def frame(spark, spec, *rows):
    return spark.createDataFrame(list(rows), spec.schema)


@pytest.fixture(scope="module")
def aircraft(spark):
    return frame(spark, schemas.AIRCRAFT, ("A1", "A320", "Airbus"), ("A2", "A321", "Airbus"), ("E1", "E195", "Embraer"))


@pytest.fixture(scope="module")
def flights(spark):
    return frame(
        spark,
        schemas.FLIGHTS,
        ("A1", date(2024, 1, 1), 10.0, 4, 1, 30.0, 1),
        ("A1", date(2024, 6, 1), 2.0, 2, 0, 0.0, 0),
        ("A2", date(2024, 1, 1), 6.0, 3, 1, 20.0, 0),
        ("A2", date(2023, 1, 1), 1.0, 0, 0, 0.0, 2),
        ("E1", date(2024, 1, 1), 0.0, 1, 0, 0.0, 0),
        ("ZZ", date(2024, 1, 1), 99.0, 9, 9, 9.0, 9),
    )


@pytest.fixture(scope="module")
def unavailability(spark):
    return frame(
        spark,
        schemas.UNAVAILABILITY,
        ("A1", 202401, "SCHEDULED", 5.0),
        ("A1", 202412, "UNSCHEDULED", 1.0),
        ("A2", 202201, "SCHEDULED", 7.0),
        ("E1", 202401, "SCHEDULED", 365.0),
    )


def test_utilization(flights, unavailability, aircraft):
    out = {(r.manufacturer, r.year): r for r in kpis.utilization(flights, unavailability, aircraft).collect()}
    assert set(out) == {("Airbus", 2024), ("Airbus", 2023), ("Embraer", 2024)}
    airbus = out["Airbus", 2024].asDict()
    assert airbus == {
        "manufacturer": "Airbus",
        "year": 2024,
        "fh": 9.0,
        "take_offs": 4.5,
        "adoss": 2.5,
        "adosu": 0.5,
        "ados": 3.0,
        "adis": 362.0,
        "du": 0.0,
        "dc": 0.01,
        "dyr": pytest.approx(22.22),
        "cnr": pytest.approx(11.11),
        "tdr": pytest.approx(66.67),
        "avg_delay_x100": 2500.0,
    }


def test_zero_denominators_give_null(flights, unavailability, aircraft):
    out = {(r.manufacturer, r.year): r for r in kpis.utilization(flights, unavailability, aircraft).collect()}
    assert (out["Embraer", 2024].du, out["Embraer", 2024].dc, out["Embraer", 2024].avg_delay_x100) == (None,) * 3
    assert (out["Airbus", 2023].dyr, out["Airbus", 2023].cnr, out["Airbus", 2023].tdr) == (None,) * 3


def test_reporting_rates(spark, flights, aircraft):
    day = date(2024, 3, 1)
    reports = frame(
        spark,
        schemas.REPORTS,
        *[(i, "A1", day, "PIREP", None, "POSTFLIGHTREPORT") for i in range(3)],
        (3, "A2", day, "MAREP", "BCN", "POSTFLIGHTREPORT"),
        (4, "A2", day, "MAREP", "BCN", "TECHNICALLOGBOOK"),
        (5, "E1", day, "PIREP", None, "POSTFLIGHTREPORT"),
        (6, "A1", date(1999, 1, 1), "PIREP", None, "POSTFLIGHTREPORT"),
    )
    out = {tuple(r)[:2]: tuple(r)[2:] for r in kpis.reporting(reports, flights, aircraft).collect()}
    assert out == {("Airbus", 2024): (222.0, 44.0), ("Embraer", 2024): (None, 100.0)}
    roles = {tuple(r)[:3]: tuple(r)[3:] for r in kpis.reporting(reports, flights, aircraft, per_role=True).collect()}
    assert roles == {
        ("Airbus", 2024, "PIREP"): (167.0, 33.0),
        ("Airbus", 2024, "MAREP"): (pytest.approx(56.0), 11.0),
        ("Embraer", 2024, "PIREP"): (None, 100.0),
    }
    shown = kpis.presented(kpis.reporting(reports, flights, aircraft, per_role=True)).collect()
    assert [r.role for r in shown] == ["MAREP", "PIREP", "PIREP"]


@pytest.fixture(scope="module")
def raw(spark):
    t = datetime
    flights = spark.createDataFrame(
        [
            ("A1", t(2024, 1, 1, 8), t(2024, 1, 1, 10), t(2024, 1, 1, 8), t(2024, 1, 1, 10, 30), None),
            ("A1", t(2024, 1, 1, 9), t(2024, 1, 1, 10), t(2024, 1, 1, 9), t(2024, 1, 1, 10), False),
            ("A1", t(2024, 1, 2, 9), t(2024, 1, 2, 10), t(2024, 1, 2, 9), None, False),
            ("A1", t(2024, 1, 3, 9), t(2024, 1, 3, 10), t(2024, 1, 3, 9), t(2024, 1, 3, 12), True),
            ("ZZ", t(2024, 1, 1, 8), t(2024, 1, 1, 9), t(2024, 1, 1, 8), t(2024, 1, 1, 9), False),
        ],
        "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz,"
        " actualdeparture timestamp_ntz, actualarrival timestamp_ntz, cancelled boolean",
    )
    maintenance = spark.createDataFrame(
        [("A2", t(2024, 2, 1), t(2024, 2, 2, 12), True), ("A2", t(2024, 2, 1), t(2024, 2, 2), None)],
        "aircraftregistration string, scheduleddeparture timestamp_ntz, scheduledarrival timestamp_ntz, programmed boolean",
    )
    lookup = spark.createDataFrame(
        [("a1", "", "A320", "Airbus"), ("A2", "", "A320", "Airbus"), ("A2", "", "B737", "Boeing"), ("ZZ", "", "E195", "Embraer")],
        schemas.AIRCRAFT_LOOKUP_FILE,
    )
    return flights, maintenance, lookup


def test_raw_utilization_truncates_and_counts_grounded_aircraft(raw):
    out = {r.manufacturer: r for r in raw_kpis.utilization(*raw).collect()}
    assert set(out) == {"Airbus", "ZZ"}  # other makers are grouped by registration
    airbus = out["Airbus"]
    # Two aircraft; 3 take-offs and 3.5 hours on one of them.
    assert (airbus.fh, airbus.take_offs, airbus.adoss, airbus.adosu, airbus.ados) == (1.75, 1, 0.75, 0.5, 1.25)
    assert (airbus.dyr, airbus.cnr) == (pytest.approx(33.33), pytest.approx(33.33))
    assert airbus.tdr == 100 - 66  # 66.67 truncated
    assert airbus.avg_delay_x100 == 3000.0
    assert (out["ZZ"].tdr, out["ZZ"].avg_delay_x100) == (100, None)


def test_reconcile_keeps_groups_of_either_side(spark):
    schema = "manufacturer string, year int, rrh double"
    left = spark.createDataFrame([("Airbus", 2024, 2.0), ("Embraer", 2024, 1.0)], schema)
    right = spark.createDataFrame([("Airbus", 2024, 1.5), ("ZZ", 2024, 3.0)], schema)
    out = {r.manufacturer: (r.rrh_wh, r.rrh_raw, r.rrh_delta) for r in reconcile(left, right).collect()}
    assert out == {"Airbus": (2.0, 1.5, 0.5), "Embraer": (1.0, None, None), "ZZ": (None, 3.0, None)}


def test_key_and_reference_checks_find_violations(spark, flights, unavailability, aircraft):
    twice = aircraft.union(frame(spark, schemas.AIRCRAFT, ("A1", "A319", "Airbus")))
    assert tuple(checks.key_check(twice, schemas.AIRCRAFT).first()) == ("aircraft", 4, 1, 0)
    assert tuple(checks.key_check(aircraft.limit(0), schemas.AIRCRAFT).first()) == ("aircraft", 0, 0, 0)
    with pytest.raises(checks.IntegrityError, match="1 repeated keys"):
        checks.require_unique_key(twice, schemas.AIRCRAFT)
    found = checks.reference_check(flights, schemas.FLIGHTS, schemas.FLIGHTS.references[0], aircraft).first()
    assert tuple(found) == ("flights", "aircraft_id", "aircraft", 1, 1)
