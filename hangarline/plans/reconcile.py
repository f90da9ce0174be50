"""Warehouse KPIs next to raw KPIs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("manufacturer", "year", "role")


def reconcile(warehouse: DataFrame, raw: DataFrame) -> DataFrame:
    """Full outer join on the common keys: `<kpi>_wh`, `<kpi>_raw` and `<kpi>_delta` for every KPI."""
    keys = [k for k in KEYS if k in warehouse.columns]
    kpis = [c for c in warehouse.columns if c not in keys]

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*keys, *[F.col(k).cast("double").alias(k + suffix) for k in kpis])

    joined = suffixed(warehouse, "_wh").join(suffixed(raw, "_raw"), keys, "full")
    columns = []
    for k in kpis:
        delta = F.col(f"{k}_wh") - F.col(f"{k}_raw")
        columns += [f"{k}_wh", f"{k}_raw", delta.alias(f"{k}_delta")]
    return joined.select(*keys, *columns)
