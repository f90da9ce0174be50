"""The whole build, publishing and reading back."""

import pytest
from compare import SF_SMALL, connect, differences
from pyspark.sql import functions as F

import duckdb_oracles
from hangarline import schemas
from hangarline.operators import checks, facts, quality
from hangarline.plans import pipeline
from hangarline.sources.sample_tables import sample_tables
from hangarline.warehouse import PublicationConflict, Warehouse, temp_views


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("warehouse"))


@pytest.fixture(scope="module")
def built(spark, root):
    return pipeline.run(spark, sample_tables(spark, SF_SMALL), root, keep_intermediates=True)


@pytest.mark.parametrize(
    ("table", "query"),
    [
        ("aircraft", "dim_aircraft"),
        ("date", "dim_date"),
        ("month", "dim_month"),
        ("flights", "fact_flights"),
        ("unavailability", "fact_unavailability"),
        ("reports", "fact_reports"),
        ("dq_audit", "dq_audit"),
    ],
)
def test_written_tables_equal_the_oracle(built, table, query):
    written = built.table(table)
    if table in schemas.TABLES:
        written = written.select(schemas.TABLES[table].columns)
    assert differences(written, connect(SF_SMALL), duckdb_oracles.oracle_sql()[query]) is None


@pytest.mark.parametrize(
    ("method", "query"),
    [("utilization", "kpi_utilization"), ("reporting", "kpi_reporting"), ("reporting_per_role", "kpi_reporting_role")],
)
def test_kpis_on_the_written_tables(built, method, query):
    assert differences(getattr(built, method)(), connect(SF_SMALL), duckdb_oracles.oracle_sql()[query]) is None


def test_keys_and_references_hold(built):
    tables = built.tables()
    assert {tuple(r)[2:] for r in checks.check_primary_keys(tables).collect()} == {(0, 0)}
    assert {tuple(r)[3:] for r in checks.check_references(tables).collect()} == {(0, 0)}


def test_flights_add_up(spark, built):
    source = sample_tables(spark, SF_SMALL).flights.count()
    repaired, departures = built.table("flights_repaired"), built.table("flight_departures")
    assert repaired.count() == source
    removed = {r.item: r.row_count for r in built.table("dq_summary").collect()}["rule BR-21"]
    assert repaired.where(quality.contestable()).count() == departures.where("survives").count() + removed
    assert facts.daily_flights(departures).selectExpr("sum(takeoff + cancellations)").first()[0] == source - removed


def test_open_finds_the_last_published_run(spark, built, root):
    assert Warehouse.open(spark, root).run_id == built.run_id
    unpublished = Warehouse.new_run(spark, root)
    unpublished.write("month", built.table("month"))
    assert Warehouse.open(spark, root).run_id == built.run_id
    unpublished.publish()
    assert Warehouse.open(spark, root).run_id == unpublished.run_id


def test_open_without_a_warehouse(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, str(tmp_path))


def test_summary_counts_every_stage(built):
    summary = built.table("dq_summary")
    stages = summary.where("item NOT LIKE 'published %'")
    assert differences(stages, connect(SF_SMALL), duckdb_oracles.oracle_sql()["dq_summary"]) is None
    assert summary.where("item LIKE 'published %'").count() == len(schemas.TABLES)


@pytest.mark.parametrize(
    ("table", "change", "named"),
    [
        ("reports", {"report_id": "0L"}, "reports: 1 repeated keys"),
        ("reports", {"reporter_class": "CAST(NULL AS STRING)"}, "incomplete rows"),
        ("unavailability", {"month_id": "999912"}, "unavailability.month_id"),
    ],
)
def test_unsound_tables_are_not_published(spark, built, tmp_path, table, change, named):
    for broken in (False, True):
        warehouse = Warehouse.new_run(spark, str(tmp_path))
        for name, df in built.tables().items():
            if broken and name == table:
                df = df.withColumns({column: F.expr(value) for column, value in change.items()})
            warehouse.write(name, df)
        if broken:
            with pytest.raises(checks.IntegrityError, match=named):
                pipeline.publish(warehouse)
        else:
            pipeline.publish(warehouse)
            sound = warehouse.run_id
    assert Warehouse.open(spark, str(tmp_path)).run_id == sound


def test_what_remains_of_runs(spark, tmp_path):
    src = sample_tables(spark, SF_SMALL)
    failed = Warehouse(spark, str(tmp_path), "20000101T000000-failed")
    failed.write("month", spark.createDataFrame([(202401, 1, 2024)], schemas.MONTH.schema))
    run = pipeline.run(spark, src, str(tmp_path))
    remaining = {path.name for path in (tmp_path / "runs" / run.run_id).iterdir()}
    assert remaining == {*schemas.TABLES, "dq_audit", "dq_summary"}
    assert run.remove_older_runs() == [failed.run_id]
    assert [path.name for path in (tmp_path / "runs").iterdir()] == [run.run_id]


def test_of_two_builds_at_once_one_is_published(spark, built, tmp_path):
    first, second = Warehouse.new_run(spark, str(tmp_path)), Warehouse.new_run(spark, str(tmp_path))
    for run in (second, first):
        run.write("month", built.table("month"))
    second.publish()
    with pytest.raises(PublicationConflict):
        first.publish()
    assert Warehouse.open(spark, str(tmp_path)).run_id == second.run_id
    third = Warehouse.new_run(spark, str(tmp_path))
    third.publish()
    assert Warehouse.open(spark, str(tmp_path)).run_id == third.run_id


def test_cleaning_spares_a_run_that_may_still_be_published(spark, tmp_path):
    def run(started, after, name):
        warehouse = Warehouse(spark, str(tmp_path), f"{started}-after{after}-{name}")
        warehouse.write("month", spark.createDataFrame([(202401, 1, 2024)], schemas.MONTH.schema))
        return warehouse

    failed, old = run("20240101T000000", 0, "aa"), run("20240102T000000", 0, "bb")
    old.publish()
    slow, current = run("20240103T000000", 1, "cc"), run("20240104T000000", 1, "dd")
    assert old.remove_older_runs() == [failed.run_id]
    assert Warehouse.open(spark, str(tmp_path)).remove_older_runs() == []
    current.publish()
    assert current.remove_older_runs() == [old.run_id, slow.run_id]  # the turn of the slow one is over
    with pytest.raises(PublicationConflict):
        slow.publish()


def test_a_publication_without_content_is_none(spark, tmp_path):
    run = Warehouse.new_run(spark, str(tmp_path))
    run.publish()
    (tmp_path / "publications" / "0000000002").write_text("")
    assert Warehouse.open(spark, str(tmp_path)).run_id == run.run_id
    following = Warehouse.new_run(spark, str(tmp_path))
    following.publish()
    assert Warehouse.open(spark, str(tmp_path)).run_id == following.run_id


def test_a_build_reads_each_source_table_once(spark, tmp_path):
    """Counts for the summary included: every later step starts from what was written."""
    src, opened = sample_tables(spark, SF_SMALL), []

    class Counting(type(src)):
        def __getattr__(self, name):
            opened.append(name)
            return super().__getattr__(name)

    src.__class__ = Counting
    run = pipeline.run(spark, src, str(tmp_path))
    reads = {name: opened.count(name) for name in src.NAMES}
    assert all(reads[name] == 1 for name in ("flights", "maintenance", "postflightreports", "technicallogbookorders", "personnel"))
    assert run.table("dq_summary").where("item = 'source flights'").first().row_count == src.flights.count()


def test_conflicting_aircraft_stop_the_build(spark, tmp_path):
    src = sample_tables(spark, SF_SMALL)
    lookup = src.aircraft_lookup
    broken = src.with_frames(aircraft_lookup=lookup.union(lookup.selectExpr("aircraft_reg_code", "''", "'other'", "'Airbus'")))
    with pytest.raises(checks.IntegrityError, match="aircraft"):
        pipeline.run(spark, broken, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, str(tmp_path))


def test_year_filter_prunes_partitions(built):
    flights = built.table("flights").where("year = 1996").select("takeoff")
    plan = flights._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<takeoff:bigint>" in plan


def test_temporary_views_last_for_the_block(spark, built):
    with temp_views(spark, built.tables()) as session:
        assert session.sql("SELECT count(*) FROM flights JOIN aircraft USING (aircraft_id)").first()[0] > 0
    assert not spark.catalog.tableExists("flights")
