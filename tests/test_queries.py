"""Every registered query against DuckDB, and properties of the plans."""

import re

import pytest
from compare import SF_SMALL, connect, differences

import __spark_entry__ as entry_point
import duckdb_oracles
import fleet_queries

QUERIES = fleet_queries.queries()
ORACLES = duckdb_oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert ORACLES.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 14


def physical_plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name):
    plan = physical_plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas|InArrow|BatchEvalPython", plan)


@pytest.mark.parametrize("name", ["br21_flagged", "fact_flights", "kpi_utilization", "dq_audit"])
def test_overlap_window_is_split_by_day(spark, name):
    windows = re.findall(r"Window \[lead\(departure#.*?windowspecdefinition\((.*?)\)", physical_plan(spark, name))
    spans = [spec for spec in windows if re.match(r"aircraft_id#\d+, span#\d+, departure#\d+ ", spec)]
    ends = [spec for spec in windows if re.match(r"aircraft_id#\d+, departure#\d+ ", spec)]
    assert spans and ends and len(spans) + len(ends) == len(windows)


def executed_plan(df):
    """The plan as it ran, after reuse of exchanges."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize(("name", "scans"), [("fact_flights", 1), ("br21_flagged", 1), ("dq_audit", 2)])
def test_flights_are_read_once_for_each_shape(spark, name, scans):
    """At most: AQE takes branches out of the plan that turn out to be empty."""
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    assert 1 <= len(re.findall(r"FileScan parquet \[[^\]]*l_shipdate", plan)) <= scans
    assert "ReusedExchange" in plan


def test_flights_fact_is_aggregated_by_hash(spark):
    plan = executed_plan(QUERIES["fact_flights"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan)) <= 6


def test_scans_read_only_what_they_need(spark):
    plan = physical_plan(spark, "src_dates")
    read = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert read and all("l_extendedprice" not in r and "o_totalprice" not in r and "props" not in r for r in read)
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_shipdate", plan)) == 1


@pytest.mark.parametrize("name", ["kpi_utilization", "kpi_reporting_role", "fact_reports", "dq_audit", "raw_atomic"])
def test_nothing_depends_on_small_sides(spark, con, name):
    """The same results and no nested loops if no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in physical_plan(spark, name)
        assert differences(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Row counts stated in FIXTURES.md for the smallest scale.
EXPECTED_ROWS = {
    "dim_aircraft": 9,
    "fact_flights": 4632,
    "kpi_utilization": 14,
    "kpi_reporting_role": 28,
    "src_personnel": 7,
    "fact_reports": 900,
    "dim_date": 2486,
    "raw_kpi_utilization": 21,
    "raw_kpi_reporting_role": 42,
    "reconcile_utilization": 21,
}


@pytest.mark.parametrize(("name", "rows"), EXPECTED_ROWS.items())
def test_expected_shape(spark, name, rows):
    assert QUERIES[name](spark, SF_SMALL).count() == rows


def test_session_zone_does_not_bend_durations(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("fact_flights", "raw_kpi_utilization"):
            assert differences(QUERIES[name](spark, SF_SMALL), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
