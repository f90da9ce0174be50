from pyspark.sql import functions as F

from hangarline.functions import clean_code, micros_between, month_key, ratio, round_places


def test_rounding_looks_at_the_scaled_double(spark):
    row = spark.range(1).select(*[round_places(F.lit(x), 2).alias(f"x{i}") for i, x in enumerate((1.005, 2.5, -1.235))])
    assert tuple(row.first()) == (1.0, 2.5, -1.24)


def test_ratio_by_zero_is_null(spark):
    row = spark.range(1).select(ratio(F.lit(1), F.lit(0)), ratio(F.lit(1.0), F.lit(0.0)), ratio(F.lit(1), F.lit(4)))
    assert tuple(row.first()) == (None, None, 0.25)


def test_codes_and_keys(spark):
    row = spark.sql("SELECT '\t xy-1 \n' AS code, DATE '2024-03-09' AS day, CAST(NULL AS STRING) AS none")
    assert tuple(row.select(clean_code(F.col("code")), month_key(F.col("day")), clean_code(F.col("none"))).first()) == (
        "XY-1",
        202403,
        None,
    )


def test_durations_keep_microseconds_and_sign(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 01:59:59.5' AS a, TIMESTAMP_NTZ '2024-03-10 03:00:00.000001' AS b")
    found = row.select(micros_between(F.col("a"), F.col("b")), micros_between(F.col("b"), F.col("a"))).first()
    assert tuple(found) == (3_600_500_001.0, -3_600_500_001.0)


def test_sums_of_durations_do_not_depend_on_partitions(spark):
    start, end = "TIMESTAMP_NTZ '1970-01-01 00:00:00'", "TIMESTAMP_NTZ '2020-01-01 00:00:00'"
    columns = [f"{start} AS a", f"{end} - make_dt_interval(0, 0, 0, id / 1000000) AS b"]
    expected = 2000 * 1_577_836_800_000_000 - sum(range(2000))
    assert expected > 2**53
    for parts in (1, 5):
        rows = spark.range(0, 2000, 1, parts).selectExpr(*columns)
        assert rows.agg(F.sum(micros_between(F.col("a"), F.col("b")))).first()[0] == expected
