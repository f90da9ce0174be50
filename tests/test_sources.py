from datetime import date, datetime, timedelta

import pytest

from hangarline.sources import jdbc_tables, parquet_tables, read_settings
from hangarline.sources import tables as T
from hangarline.sources.sample_tables import sample_tables

ENV = {"FLEET_DB_NAME": "ops", "FLEET_DB_USER": "me", "FLEET_DB_PASSWORD": "secret", "FLEET_DB_HOST": "h", "FLEET_DB_PORT": "5432"}


def test_environment_wins_over_file(tmp_path):
    file = tmp_path / "db.txt"
    file.write_text("dbname = filedb\nuser=fileuser\npassword=a=b\nip=filehost\nport=1\n# no pair\n")
    settings = read_settings(file, env={"FLEET_DB_HOST": "envhost", "FLEET_DB_USER": ""})
    assert (settings.dbname, settings.user, settings.password) == ("filedb", "fileuser", "a=b")
    assert settings.url == "jdbc:postgresql://envhost:1/filedb"


def test_environment_alone_with_own_prefix():
    env = {k.replace("FLEET_DB_", "OPS_"): v for k, v in ENV.items()}
    assert read_settings(env=env, env_prefix="OPS_").dbname == "ops"


def test_missing_settings_are_named(tmp_path):
    with pytest.raises(FileNotFoundError, match=r"\['password', 'port'\].*FLEET_DB_PASSWORD, FLEET_DB_PORT"):
        read_settings(tmp_path / "none.txt", env={k: ENV[k] for k in ENV if k[9:] not in ("PASSWORD", "PORT")})


def test_password_is_not_shown():
    assert "secret" not in repr(read_settings(env=ENV))


def test_jdbc_reads_name_their_columns():
    options = T.jdbc_options(read_settings(env=ENV), "flights")
    assert options["dbtable"].endswith('scheduledarrival, actualdeparture, actualarrival, cancelled FROM "AIMS".flights) AS flights')
    assert options["preferTimestampNTZ"] == "true" and "partitionColumn" not in options
    options = T.jdbc_options(read_settings(env=ENV), "postflightreports")
    assert "reportingdate::date AS reportingdate" in options["dbtable"]


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_jdbc_ranges_hold_every_row_once(spark, partitions):
    low, high = datetime(2020, 1, 1), datetime(2020, 3, 1)
    moments = [None, datetime(1990, 1, 1), low, datetime(2020, 1, 9, 3, 4, 5, 678901), high, datetime(2050, 1, 1)]
    moments += [low + i * (high - low) / partitions for i in range(partitions + 1)]
    rows = spark.createDataFrame([(m,) for m in moments], "at timestamp_ntz")
    ranges = T.range_predicates("at", low, high, partitions)
    assert len(ranges) == partitions + 1
    assert sum(rows.where(condition).count() for condition in ranges) == len(moments)


def cuts_of(spark, moments, partitions):
    spark.createDataFrame([(m,) for m in moments], "at timestamp_ntz").createOrReplaceTempView("moments")
    rows = spark.sql(f"SELECT cut FROM {T.quantile_query('moments', 'at', partitions)}").collect()
    return T.distinct_cuts(row.cut for row in rows)


def test_ranges_of_equal_row_count_are_not_bent_by_outliers(spark):
    start = datetime(2021, 3, 4)
    moments = [start + timedelta(minutes=i) for i in range(4000)]
    moments += [datetime(1900, 1, 1), datetime(9999, 1, 1), None, None]
    ranges = T.cut_predicates("at", cuts_of(spark, moments, 16))
    rows = spark.table("moments")
    sizes = [rows.where(condition).count() for condition in ranges]
    assert sum(sizes) == len(moments) and sizes[-1] == 2
    assert len(sizes) == 17 and max(sizes[:-1]) <= 2 * 4002 / 16
    narrow = [rows.where(c).count() for c in T.range_predicates("at", datetime(1900, 1, 1), datetime(9999, 1, 1), 16)]
    assert max(narrow) > 3900  # what equal widths do


def test_ranges_of_repeated_dates_and_of_an_empty_table(spark):
    moments = [datetime(2021, 1, 1)] * 50 + [datetime(2021, 1, 2 + i % 3) for i in range(10)]
    ranges = T.cut_predicates("at", cuts_of(spark, moments, 8))
    sizes = [spark.table("moments").where(condition).count() for condition in ranges]
    assert sum(sizes) == 60 and max(sizes) == 50
    assert T.cut_predicates("at", cuts_of(spark, [None], 8)) == ["at IS NOT NULL", "at IS NULL"]
    assert T.cut_predicates("day", [date(2021, 1, 1)])[0] == "day <= DATE '2021-01-01'"


def test_jdbc_registrations_are_reduced_in_the_database():
    options = T.jdbc_options(read_settings(env=ENV), "workorders")
    assert options["dbtable"].startswith("(SELECT DISTINCT aircraftregistration FROM")
    assert "partitionColumn" not in options


def test_jdbc_without_driver_fails_clearly(spark, tmp_path):
    lookup = tmp_path / "lookup.csv"
    lookup.write_text("aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n")
    src = jdbc_tables(spark, read_settings(env=ENV), str(lookup), str(tmp_path / "none.csv"))
    assert src.aircraft_lookup.isEmpty()  # tables are opened one by one
    with pytest.raises(Exception, match="org.postgresql.Driver"):
        src.flights  # noqa: B018


def test_every_source_needs_a_reader():
    with pytest.raises(ValueError, match="no reader for .*'flights'"):
        T.SourceTables({})


def test_reference_files(spark, tmp_path):
    lookup = tmp_path / "lookup.csv"
    lookup.write_text(
        "aircraft_manufacturer,aircraft_reg_code,extra,aircraft_model,manufacturer_serial_number\n"
        'Airbus," xy-aaa ",1,"A320, neo",17\n'
    )
    assert [tuple(r) for r in T.aircraft_lookup_csv(spark, str(lookup)).collect()] == [(" xy-aaa ", "17", "A320, neo", "Airbus")]
    people = tmp_path / "people.csv"
    people.write_text("reporteurid,airport\n7,BCN\n")
    assert [tuple(r) for r in T.personnel_csv_or_empty(spark, str(people)).collect()] == [(7, "BCN")]


def test_missing_personnel_file_is_empty_but_missing_lookup_is_an_error(spark, tmp_path):
    empty = T.personnel_csv_or_empty(spark, str(tmp_path / "none.csv"))
    assert empty.columns == ["reporteurid", "airport"] and empty.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        T.aircraft_lookup_csv(spark, str(tmp_path / "none.csv"))


def test_reference_file_without_a_column(spark, tmp_path):
    people = tmp_path / "people.csv"
    people.write_text("reporteurid,city\n7,BCN\n")
    with pytest.raises(ValueError, match="airport"):
        T.personnel_csv_or_empty(spark, str(people))


def test_landed_tables_round_trip(spark, tmp_path):
    src = sample_tables(spark, "/root/testdata/sf0.001")
    again = T.landed(src, str(tmp_path / "landing"))
    for name, columns in T.SOURCE_COLUMNS.items():
        assert getattr(again, name).columns == columns
        assert getattr(again, name).exceptAll(getattr(src, name).select(columns)).isEmpty()
        assert getattr(again, name).count() == getattr(src, name).count()


def test_parquet_tables(spark, tmp_path):
    src = sample_tables(spark, "/root/testdata/sf0.001")
    for name in T.JDBC_TABLES:
        getattr(src, name).write.parquet(str(tmp_path / name))
    lookup = tmp_path / "lookup.csv"
    lookup.write_text("aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n")
    again = parquet_tables(spark, str(tmp_path), str(lookup), str(tmp_path / "none.csv"))
    assert again.flights.count() == src.flights.count()
