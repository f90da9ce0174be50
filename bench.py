"""Times the headline queries and prints one JSON line.

Queries that start from the source rows (`fact_*`, `kpi_*`, `raw_kpi_*`, ...) run against the noop sink.
`etl_build` writes a whole warehouse, and `wh_*` are the KPI queries on the written tables.
Each figure is the median of three runs, after one warm-up run of everything (`etl_build`: one run).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid

from fleet_queries import queries
from hangarline.plans import pipeline
from hangarline.session import local_session
from hangarline.sources.sample_tables import sample_tables
from hangarline.warehouse import Warehouse

HEADLINE = (
    "fact_flights",
    "fact_unavailability",
    "fact_reports",
    "br21_flagged",
    "dq_audit",
    "dq_summary",
    "chk_primary_keys",
    "chk_foreign_keys",
    "reconcile_utilization",
    "reconcile_reporting",
    "reconcile_reporting_role",
    "kpi_utilization",
    "kpi_reporting",
    "kpi_reporting_role",
    "raw_kpi_utilization",
    "raw_kpi_reporting",
    "raw_kpi_reporting_role",
)
WAREHOUSE_KPIS = ("utilization", "reporting", "reporting_per_role")


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    shared = os.environ.get("BENCH_ROOT") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise SystemExit("set BENCH_ROOT to a folder that driver and executors share")
    root = f"{shared or tempfile.gettempdir()}/bench-{uuid.uuid4().hex}"
    registered = queries()

    def build() -> Warehouse:
        return pipeline.run(spark, sample_tables(spark, sf_dir), root)

    def from_source(name: str):
        return lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def from_warehouse(method: str):
        return lambda: getattr(warehouse, method)().collect()

    warehouse = build()
    actions = {name: from_source(name) for name in HEADLINE}
    actions |= {f"wh_{method}": from_warehouse(method) for method in WAREHOUSE_KPIS}
    for action in actions.values():
        action()

    times = {name: statistics.median(seconds(action) for _ in range(3)) for name, action in actions.items()}
    times["etl_build"] = seconds(build)
    spark.stop()

    times = {name: round(value, 3) for name, value in times.items()}
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
