"""The three shared dimensions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangarline.functions import clean_code, clean_text
from hangarline.operators import extract
from hangarline.schemas import require_columns


def aircraft(rows: DataFrame) -> DataFrame:
    """Distinct, cleaned aircraft; those without model or manufacturer are left out.

    `rows` may be the whole aircraft universe or just the lookup: a registration missing from the
    lookup has no model and is left out anyway, so the lookup alone gives the same dimension
    without reading the operational tables.
    """
    columns = ["aircraft_id", "model", "manufacturer"]
    require_columns(rows, columns, "aircraft")
    return (
        rows.dropna(subset=columns)
        .select(
            clean_code(F.col("aircraft_id")).alias("aircraft_id"),
            clean_text(F.col("model")).alias("model"),
            clean_text(F.col("manufacturer")).alias("manufacturer"),
        )
        .distinct()
    )


def aircraft_from_lookup(lookup: DataFrame) -> DataFrame:
    return aircraft(extract.aircraft_lookup(lookup))


def dates(rows: DataFrame) -> DataFrame:
    """Distinct valid days with their parts; anything that is not a date is left out."""
    require_columns(rows, ["date_id"], "dates")
    days = rows.select(F.col("date_id").try_cast("date").alias("date_id")).where("date_id IS NOT NULL").distinct()
    return days.select("date_id", *extract.day_parts(F.col("date_id")))


def months(dates: DataFrame) -> DataFrame:
    return dates.select(F.expr("year * 100 + month").alias("month_id"), "month", "year").distinct()
