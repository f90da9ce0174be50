"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000

# Every character a Unicode-aware strip removes. Spark's one-argument trim only
# removes blanks, and a regular expression per row is far dearer than btrim with a set.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(value: Column) -> Column:
    """Text without surrounding whitespace; NULL stays NULL."""
    return F.btrim(value.cast("string"), F.lit(WHITESPACE))


def clean_code(value: Column) -> Column:
    """Registration codes are compared upper-case and stripped."""
    return F.upper(clean_text(value))


def false_if_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def micros_sql(start: str, end: str) -> str:
    """Whole microseconds from start to end, both without zone, as SQL: the session's zone plays no part.

    A bigint, so that sums are exact and independent of row order, up to 2.5 billion hours; beyond that they
    raise. The difference is an interval of days to seconds; its fields are whole numbers but for the seconds.
    """
    units = {"DAY": MICROS_PER_DAY, "HOUR": MICROS_PER_HOUR, "MINUTE": MICROS_PER_MINUTE}
    whole = " + ".join(f"extract({unit} FROM {end} - {start}) * {micros}L" for unit, micros in units.items())
    return f"({whole} + CAST(extract(SECOND FROM {end} - {start}) * 1000000 AS BIGINT))"


def micros_between(start: Column, end: Column) -> Column:
    """`micros_sql` of two columns."""
    length = end - start

    def part(name: str) -> Column:
        return F.extract(F.lit(name), length)

    whole = part("DAY") * MICROS_PER_DAY + part("HOUR") * MICROS_PER_HOUR
    return whole + part("MINUTE").cast("bigint") * MICROS_PER_MINUTE + (part("SECOND") * 1_000_000).cast("bigint")


def month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator (ANSI mode would raise)."""
    return numerator / F.nullif(denominator, F.lit(0))


def round_places(value: Column, places: int) -> Column:
    """Rounds the scaled double itself; round(x, n) on doubles differs between engines."""
    scale = 10.0**places
    return F.round(value * F.lit(scale)) / F.lit(scale)
