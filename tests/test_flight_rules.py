"""BR-23, BR-21 and the flight measures."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from builders import FLIGHT_SCHEMA, at, by_aircraft, flight, flights_frame

from hangarline.operators import facts, quality

def fact(spark, rows):
    return by_aircraft(facts.flights_fact(flights_frame(spark, rows)))


def removed_flights(flights):
    return quality.removed_flights(quality.flight_outcomes(flights))


def kept_and_removed(spark, rows):
    flights = flights_frame(spark, rows)
    kept = Counter(map(tuple, quality.without_overlaps(flights).collect()))
    return kept, Counter({tuple(r[:6]): r.copies for r in removed_flights(flights).collect()})


def sequential_rule(rows):
    """The rule as a plain loop over sorted flights: the earlier of two overlapping neighbours goes."""

    def order(row):
        aircraft, day, departs, arrives, scheduled, _ = row
        return (aircraft, departs, arrives, (scheduled is not None, scheduled or datetime.min), day)

    kept, removed = Counter(), Counter()
    flown = [r for r in rows if r[0] is not None and not r[5] and r[2] is not None and r[3] is not None]
    rest = Counter(rows) - Counter(flown)
    kept += rest
    flown.sort(key=order)
    for this, following in zip(flown, flown[1:] + [None], strict=True):
        overlapped = following is not None and following[0] == this[0] and following[2] < this[3]
        (removed if overlapped else kept)[this] += 1
    return +kept, +removed


def test_swapped_times_give_positive_hours(spark):
    rows = [flight("T1", "2024-03-01 00:40", "2024-02-29 22:25"), flight("T1", "2024-02-29 06:00", "2024-02-29 06:45")]
    days = facts.flights_fact(flights_frame(spark, rows)).collect()
    assert {r.date_id.isoformat(): r.flight_hours for r in days} == {"2024-03-01": 2.25, "2024-02-29": 0.75}


def test_swap_is_strict_and_ignores_missing_times_but_not_cancellations(spark):
    rows = [
        flight("A", "10:00", "10:00"),
        flight("B", "10:00", None),
        flight("C", None, "10:00"),
        flight("D", "12:00", "10:00", cancelled=True),
    ]
    out = by_aircraft(quality.repair_swapped_times(flights_frame(spark, rows)))
    assert [out[a].times_swapped for a in "ABCD"] == [False, False, False, True]
    assert (out["D"].actualdeparture, out["D"].actualarrival) == (at("10:00"), at("12:00"))
    assert (out["B"].actualdeparture, out["B"].actualarrival) == (at("10:00"), None)


def test_earlier_of_two_overlapping_flights_is_dropped(spark):
    # One minute of overlap across midnight is enough; the same times on another aircraft do not matter.
    rows = [
        flight("T1", "2024-05-04 22:10", "2024-05-05 01:31"),
        flight("T1", "2024-05-05 01:30", "2024-05-05 02:15"),
        flight("T2", "2024-05-04 22:10", "2024-05-05 01:31"),
    ]
    out = {(r.aircraft_id, r.date_id.day): (r.takeoff, r.flight_hours) for r in facts.flights_fact(flights_frame(spark, rows)).collect()}
    assert out == {("T1", 5): (1, 0.75), ("T2", 4): (1, 3.35)}


def test_cancelled_flights_do_not_overlap(spark):
    rows = [
        flight("T1", "05:15", "06:00"),
        flight("T1", "05:30", "05:40", cancelled=True),
        flight("T1", "05:59", "07:29", cancelled=True),
        flight("T1", "06:00", "07:30"),
    ]
    out = fact(spark, rows)["T1"]
    assert (out.takeoff, out.cancellations, out.flight_hours) == (2, 2, 2.25)


def test_chain_drops_all_but_the_last(spark):
    rows = [flight("A", "08:00", "11:00"), flight("A", "10:00", "13:00"), flight("A", "12:00", "14:00")]
    kept, removed = kept_and_removed(spark, rows)
    assert list(kept) == [rows[2]]
    assert set(removed) == set(rows[:2])


def test_touching_flights_are_kept(spark):
    rows = [flight("A", "08:00", "10:00"), flight("A", "10:00", "12:00")]
    assert kept_and_removed(spark, rows)[0] == Counter(rows)


def test_only_the_next_flight_is_compared(spark):
    # The long flight contains both others but is compared with the first of them only.
    rows = [flight("A", "08:00", "20:00"), flight("A", "09:00", "10:00"), flight("A", "11:00", "12:00")]
    kept, removed = kept_and_removed(spark, rows)
    assert set(removed) == {rows[0]}
    assert set(kept) == set(rows[1:])


def test_overlap_across_days_and_gaps(spark):
    rows = [
        flight("A", "2024-01-01 23:00", "2024-01-02 02:00"),
        flight("A", "2024-01-02 01:00", "2024-01-02 03:00"),
        flight("B", "2024-01-01 23:00", "2024-01-09 02:00"),
        flight("B", "2024-01-08 01:00", "2024-01-08 03:00"),
        flight("C", "2024-01-01 23:00", "2024-01-02 02:00"),
        flight("C", "2024-01-02 02:00", "2024-01-02 03:00"),
        flight("D", "2024-01-01 10:00", "2024-02-01 00:00"),
        flight("D", "2024-01-02 10:00", "2024-01-02 12:00", cancelled=True),
        flight("D", "2024-01-03 10:00", None),
    ]
    kept, removed = kept_and_removed(spark, rows)
    assert set(removed) == {rows[0], rows[2]}
    assert sum(kept.values()) == 7


def test_identical_flights_leave_one(spark):
    copy = flight("A", "08:00", "10:00")
    instant = flight("B", "08:00", "08:00")
    cancelled = flight("C", "08:00", "10:00", cancelled=True)
    kept, removed = kept_and_removed(spark, [copy] * 5 + [instant] * 4 + [cancelled] * 3)
    assert kept == Counter({copy: 1, instant: 4, cancelled: 3})
    assert removed == Counter({copy: 4})
    out = fact(spark, [copy] * 5 + [instant] * 4 + [cancelled] * 3)
    assert (out["A"].takeoff, out["B"].takeoff, out["C"].cancellations) == (1, 4, 3)


def test_flights_without_aircraft_or_day(spark):
    rows = [
        flight(None, "08:00", "11:00"),
        flight(None, "10:00", "12:00"),
        ("A", None, at("10:00"), at("12:00"), at("12:00"), False),
        flight("A", "08:00", "11:00"),
    ]
    kept, removed = kept_and_removed(spark, rows)
    assert set(removed) == {rows[3]}  # a flight without a scheduled day still takes part
    assert sum(kept.values()) == 3
    assert fact(spark, rows) == {}


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_agree_with_a_sequential_loop(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def random_flight():
        departs = start + timedelta(minutes=30 * rng.randrange(48 * 6))
        arrives = departs + timedelta(minutes=rng.choice([0, 30, 60, 240, 1500, 6000]))
        scheduled = rng.choice([None, arrives, arrives - timedelta(minutes=20)])
        return (
            rng.choice(["A", "A", "A", "B", "C", None]),
            rng.choice([departs.date(), departs.date() + timedelta(days=1)]),
            rng.choice([departs] * 9 + [None]),
            rng.choice([arrives] * 9 + [None]),
            scheduled,
            rng.random() < 0.1,
        )

    rows = [random_flight() for _ in range(700)]
    rows += rng.choices(rows, k=300)
    assert kept_and_removed(spark, rows) == sequential_rule(rows)


def test_many_flights_with_one_placeholder_departure_leave_the_last(spark):
    start = datetime(1900, 1, 1)
    rows = [
        ("A", start.date(), start, start + timedelta(days=30000, minutes=m), start + timedelta(minutes=m % 7), False)
        for m in range(500)
    ]
    after = flight("A", "2024-01-01 08:00", "2024-01-01 10:00")
    kept, removed = kept_and_removed(spark, [*rows, after, flight("B", "09:00", "10:00")])
    assert kept[rows[-1]] == 1 and sum(kept.values()) == 3  # it lands in 1982
    assert sum(removed.values()) == 499


def test_delay_counts_from_more_than_fifteen_minutes_in_full(spark):
    rows = [
        flight("T1", "2024-01-01 04:00", "2024-01-01 05:15:00", scheduled="2024-01-01 05:00"),
        flight("T1", "2024-01-01 06:00", "2024-01-01 07:15:01", scheduled="2024-01-01 07:00"),
        flight("T1", "2024-01-01 09:00", "2024-01-01 09:50:00", scheduled="2024-01-01 10:00"),
        flight("T1", "2024-01-01 22:00", "2024-01-02 00:44:59", scheduled="2024-01-01 23:00"),
    ]
    out = fact(spark, rows)["T1"]
    assert (out.delays, out.delay_minutes) == (2, 120.0)


def test_measures_of_incomplete_and_cancelled_flights(spark):
    rows = [
        flight("A", "08:00", None, scheduled="10:00"),
        flight("B", "08:00", "12:00", scheduled="10:00", cancelled=True),
        flight("C", "08:00", "12:00", scheduled="10:00", cancelled=None),
        ("D", at("08:00").date(), at("08:00"), at("09:30"), None, False),
    ]
    out = by_aircraft(facts.flight_measures(flights_frame(spark, rows)))
    names = ("flight_hours", "takeoff", "delays", "delay_minutes", "cancellations")
    assert {a: tuple(out[a][n] for n in names) for a in "ABCD"} == {
        "A": (0.0, 1, 0, 0.0, 0),
        "B": (0.0, 0, 0, 0.0, 1),
        "C": (4.0, 1, 1, 120.0, 0),
        "D": (1.5, 1, 0, 0.0, 0),
    }


def test_day_is_the_scheduled_one_even_if_times_are_swapped(spark):
    rows = [flight("A", "2024-01-03 01:00", "2024-01-02 23:00", day="2024-01-01")]
    assert fact(spark, rows)["A"].date_id.isoformat() == "2024-01-01"


def test_day_without_kept_flights_has_no_row(spark):
    rows = [
        flight("A", "2024-01-01 23:00", "2024-01-02 02:00"),
        flight("A", "2024-01-02 01:00", "2024-01-02 03:00"),
    ]
    out = facts.flights_fact(flights_frame(spark, rows)).collect()
    assert [r.date_id.isoformat() for r in out] == ["2024-01-02"]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="scheduledarrival"):
        quality.ordered_departures(flights_frame(spark, []).drop("scheduledarrival"))


def test_extra_columns_stay_with_their_flights(spark):
    schema = FLIGHT_SCHEMA + ", number int"
    rows = [(*flight("A", "08:00", "11:00"), 1), (*flight("A", "10:00", "12:00"), 2)]
    flights = spark.createDataFrame(rows, schema)
    assert [r.number for r in quality.without_overlaps(flights).collect()] == [2]
    assert [r.number for r in removed_flights(flights).collect()] == [1]
