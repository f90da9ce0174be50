"""Report feeds, unknown aircraft, airports and ids."""

from datetime import date

import pytest
from builders import REPORT_SCHEMA

from hangarline.operators import facts, quality

DAY = date(2024, 1, 1)


def aircraft(spark, *ids):
    return spark.createDataFrame([(i, "A320", "Airbus") for i in ids], "aircraft_id string, model string, manufacturer string")


def personnel(spark, *rows):
    return spark.createDataFrame(list(rows), "reporter_id bigint, airport string")


def reports(spark, *rows, source="postflightreport"):
    return spark.createDataFrame([(*r, "NULL", source) for r in rows], REPORT_SCHEMA)


def test_unknown_aircraft_dropped_and_airports_for_both_feeds(spark):
    postflight = reports(spark, (4, "Q7", DAY, "PIREP"), (4, "gone", DAY, "PIREP"), (5, "Q8", DAY, "MAREP"))
    logbook = reports(spark, (5, "q7 ", DAY, "MAREP"), (5, "gone", DAY, "MAREP"), source="technicallogbook")
    people = personnel(spark, (5, "OSL"), (6, "LIN"))
    out = facts.reports_fact(postflight, logbook, aircraft(spark, "Q7", "Q8"), people).collect()
    assert {r.report_id: (r.aircraft_id, r.airport, r.source) for r in out} == {
        0: ("Q7", None, "POSTFLIGHTREPORT"),
        1: ("Q8", "OSL", "POSTFLIGHTREPORT"),
        2: ("Q7", "OSL", "TECHNICALLOGBOOK"),
    }


def test_aircraft_are_compared_normalised_and_missing_ones_are_unknown(spark):
    rows = reports(spark, (1, "\tq7 ", DAY, "marep"), (2, None, DAY, "pirep"), (3, "NONE", DAY, "pirep"))
    known = quality.with_known_aircraft(rows, aircraft(spark, "Q7")).collect()
    unknown = quality.with_unknown_aircraft(rows, aircraft(spark, "Q7")).collect()
    assert [r.aircraft_id for r in known] == ["Q7"]
    assert sorted(r.reporter_id for r in unknown) == [2, 3]


def test_reporter_without_entry_has_no_airport(spark):
    rows = reports(spark, (7, "A", DAY, "pirep"), (None, "A", DAY, "pirep"))
    out = facts.attributed_reports(rows, personnel(spark, (1, "BCN"))).collect()
    assert [(r.airport, r.reporter_class, r.source) for r in out] == [(None, "PIREP", "POSTFLIGHTREPORT")] * 2


def test_repeated_reporter_is_an_error(spark):
    rows = reports(spark, (1, "A", DAY, "pirep"))
    with pytest.raises(Exception, match="repeated reporter 1"):
        facts.attributed_reports(rows, personnel(spark, (1, "BCN"), (1, "MAD"))).collect()


@pytest.mark.parametrize("chunk", [3, 100_000])
def test_ids_are_dense_ordered_and_independent_of_partitioning(spark, chunk):
    rows = [
        (f"A{i % 4}", date(2024, 1, 1 + i % 3), "PIREP" if i % 2 else "MAREP", None if i % 5 else "BCN", source)
        for i in range(60)
        for source in ("POSTFLIGHTREPORT", "TECHNICALLOGBOOK")
    ] + [("HOT", DAY, "PIREP", None, "POSTFLIGHTREPORT")] * 100
    schema = "aircraft_id string, date_id date, reporter_class string, airport string, source string"
    frame = spark.createDataFrame(rows, schema)
    numbered = [
        sorted(map(tuple, facts.expanded_reports(facts.report_id_ranges(frame.repartition(n)), chunk).collect()), key=lambda r: r[0])
        for n in (1, 7)
    ]
    assert numbered[0] == numbered[1]
    assert [r[0] for r in numbered[0]] == list(range(len(rows)))
    sources = [r[5] for r in numbered[0]]
    assert sources == sorted(sources)  # post-flight first
    assert sorted(map(str, (r[1:] for r in numbered[0]))) == sorted(
        map(str, ((a, d, c, p, s) for a, d, c, p, s in rows))
    )


def test_reports_lacking_a_required_value_are_not_loaded(spark):
    rows = reports(spark, (1, "A", None, "pirep"), (1, "A", DAY, None), (1, "A", DAY, "pirep"))
    empty = reports(spark)
    out = facts.reports_fact(rows, empty, aircraft(spark, "A"), personnel(spark)).collect()
    assert [r.report_id for r in out] == [0]
