"""Primary keys, NOT NULL columns and references, checked as queries."""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangarline.schemas import FACTS, TABLES, Reference, TableSpec


def repeated_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.groupBy(*spec.key).agg(F.count("*").alias("copies")).where("copies > 1")


def key_check(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: how many rows, key values that occur more than once, rows with a missing required value.

    The rows are counted per key before anything else, so this is one shuffle.
    """
    incomplete = reduce(or_, [F.col(c).isNull() for c in spec.required])
    per_key = df.groupBy(*spec.key).agg(
        F.count("*").alias("copies"), F.sum(incomplete.cast("long")).alias("incomplete")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
        F.coalesce(F.sum("incomplete"), F.lit(0)).alias("incomplete_rows"),
    ).select(F.lit(spec.name).alias("table_name"), "*")


def check_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    checks = [key_check(df, TABLES[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, checks)


def orphans(fact: DataFrame, reference: Reference, dimension: DataFrame) -> DataFrame:
    """Fact rows whose reference has no counterpart (missing values included)."""
    keys = dimension.select(F.col(TABLES[reference.table].key[0]).alias(reference.column))
    return fact.join(keys, reference.column, "left_anti")


CHECKED = ("table_name", "column_name", "reference_table")


def _referred(fact: DataFrame, spec: TableSpec, references: Sequence[Reference]) -> DataFrame:
    """References of a fact from one pass: a row for each referring value and its number of rows.

    Values of different types meet as text; days, months and registrations have one spelling each.
    """
    values = [
        F.struct(F.lit(r.column).alias("column_name"), F.lit(r.table).alias("reference_table"), F.col(r.column).cast("string").alias("value"))
        for r in references
    ]
    rows = fact.select(F.explode(F.array(*values)).alias("referred")).select(F.lit(spec.name).alias("table_name"), "referred.*")
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


def _checked(
    tables: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], references: Sequence[tuple[TableSpec, Reference]]
) -> DataFrame:
    """A row for each reference: the number of orphan rows and of distinct orphan values, missing ones included.

    Every fact is read once and reduced to its distinct referring values; all of them meet all dimensions' keys in one
    join. References without any row are listed with zeros.
    """
    specs = {spec.name: spec for spec, _ in references}
    referred = [_referred(tables[name], spec, [r for s, r in references if s is spec]) for name, spec in specs.items()]
    # Never NULL, so that the join adds no filter to one of two branches that could share the calendar's exchange.
    keys = [
        dimensions[name].select(
            F.lit(name).alias("reference_table"),
            F.coalesce(F.col(TABLES[name].key[0]).cast("string"), F.lit("\0")).alias("value"),
            F.lit(True).alias("is_there"),
        )
        for name in sorted({r.table for _, r in references})
    ]
    found = reduce(DataFrame.unionByName, referred).join(reduce(DataFrame.unionByName, keys), ["reference_table", "value"], "left")
    is_orphan = F.col("is_there").isNull() & (F.col("copies") > 0)
    listed = [
        F.struct(
            *[F.lit(value).alias(name) for name, value in zip(CHECKED, (spec.name, r.column, r.table), strict=True)],
            F.lit(True).alias("is_there"),
            F.lit(0).alias("copies"),
        )
        for spec, r in references
    ]
    empty = found.sparkSession.range(1).select(F.inline(F.array(*listed)))
    return (
        found.select(*CHECKED, "is_there", "copies")
        .unionByName(empty)
        .groupBy(*CHECKED)
        .agg(
            F.sum(F.when(is_orphan, F.col("copies")).otherwise(0)).alias("orphan_rows"),
            F.count_if(is_orphan).alias("orphan_values"),
        )
    )


def reference_check(fact: DataFrame, spec: TableSpec, reference: Reference, dimension: DataFrame) -> DataFrame:
    """The check of one reference."""
    return _checked({spec.name: fact}, {reference.table: dimension}, [(spec, reference)])


def check_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The checks of all references of all facts."""
    return _checked(tables, tables, [(spec, reference) for spec in FACTS for reference in spec.references])


class IntegrityError(ValueError):
    """A table that must not be published."""


def require_unique_key(df: DataFrame, spec: TableSpec) -> None:
    """Runs the key check of one table and raises if it fails (one aggregated row reaches the driver)."""
    result = key_check(df, spec).first()
    if result.repeated_keys or result.incomplete_rows:
        raise IntegrityError(
            f"{spec.name}: {result.repeated_keys} repeated keys, {result.incomplete_rows} incomplete rows"
        )


def require_integrity(tables: Mapping[str, DataFrame]) -> None:
    """Runs the key, required-value and reference checks of all tables and raises if one fails.

    A row for each table and reference reaches the driver.
    """
    faults = [
        f"{r.table_name}: {r.repeated_keys} repeated keys, {r.incomplete_rows} incomplete rows"
        for r in check_primary_keys(tables).collect()
        if r.repeated_keys or r.incomplete_rows
    ]
    faults += [
        f"{r.table_name}.{r.column_name}: {r.orphan_rows} rows without a row in {r.reference_table}"
        for r in check_references(tables).collect()
        if r.orphan_rows
    ]
    if faults:
        raise IntegrityError("; ".join(faults))
