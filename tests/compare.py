"""Compares a Spark result with DuckDB rows: columns by name, kinds of types, and values as a multiset."""

from __future__ import annotations

from collections import Counter

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("supplier", "lineitem", "orders", "events")


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


KINDS = {
    "STRING": "VARCHAR",
    "INT": "INTEGER",
    "TIMESTAMP_NTZ": "TIMESTAMP",
}


def differences(spark_df, con, sql: str) -> str | None:
    """None if equal, otherwise what differs first."""
    result = con.execute(sql)
    oracle_columns = [c[0] for c in result.description]
    oracle_types = {c[0]: str(c[1]).upper() for c in result.description}
    spark_types = {n: KINDS.get(t.upper(), t.upper()) for n, t in spark_df.dtypes}
    if sorted(oracle_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(oracle_columns)}"
    types = {n: (spark_types[n], oracle_types[n]) for n in oracle_columns if spark_types[n] != oracle_types[n]}
    expected = _rows(oracle_columns, result.fetchall())
    actual = _rows(spark_df.columns, spark_df.collect())
    if expected != actual:
        missing, extra = expected - actual, actual - expected
        return (
            f"rows {sum(actual.values())} vs {sum(expected.values())};"
            f" missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
        )
    return f"types {types}" if types else None
