"""Command line: `build` a warehouse, `compare` its KPIs with the ones from the source tables, or `clean` older runs.

An error ends the process with a non-zero exit code and leaves the published warehouse as it was.
"""

import argparse
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from hangarline.plans import kpis, pipeline, raw_kpis
from hangarline.plans.reconcile import reconcile
from hangarline.sources.settings import read_settings
from hangarline.sources.tables import SourceTables, jdbc_tables, landed, parquet_tables
from hangarline.warehouse import Warehouse


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hangarline", description=__doc__)
    parser.add_argument("command", choices=("build", "compare", "clean"))
    parser.add_argument("--warehouse", required=True, help="root folder of the warehouse")
    parser.add_argument("--lookup", help="CSV with registration, model and manufacturer")
    parser.add_argument("--personnel", help="CSV with reporter and airport (may be missing)")
    parser.add_argument("--tables", help="folder with the source tables as parquet; default: read them by JDBC")
    parser.add_argument("--settings", help="file with dbname, user, password, ip and port")
    parser.add_argument("--env-prefix", default="FLEET_DB_", help="prefix of environment variables that win over it")
    parser.add_argument("--landing", help="new folder the JDBC tables are copied to, so that they are read once")
    parser.add_argument("--lower", type=datetime.fromisoformat, help="start of JDBC ranges of equal width; default: of equal row count")
    parser.add_argument("--upper", type=datetime.fromisoformat, help="end of JDBC ranges of equal width")
    parser.add_argument("--partitions", type=int, default=64, help="parallel JDBC reads per table")
    args = parser.parse_args(argv)
    if args.command != "clean" and not (args.lookup and args.personnel):
        parser.error(f"{args.command} needs --lookup and --personnel")
    return args


def sources(spark: SparkSession, args: argparse.Namespace) -> SourceTables:
    if args.tables:
        return parquet_tables(spark, args.tables, args.lookup, args.personnel)
    settings = read_settings(args.settings, env_prefix=args.env_prefix)
    src = jdbc_tables(spark, settings, args.lookup, args.personnel, args.lower, args.upper, args.partitions)
    return landed(src, args.landing) if args.landing else src


def print_rows(result: DataFrame) -> int:
    """Print the whole result, fetched one partition at a time, and return the number of its rows."""
    print("\t".join(result.columns))
    rows = 0
    for row in result.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))
        rows += 1
    return rows


def show_timed(title: str, result: DataFrame) -> None:
    """Print every row of a result, and how long this one run took."""
    start = time.perf_counter()
    rows = print_rows(kpis.presented(result))
    print(f"{title}: {rows} rows in {time.perf_counter() - start:.2f} s")


def compare(warehouse: Warehouse, src: SourceTables) -> None:
    pairs = {
        "utilization": (
            warehouse.utilization(),
            raw_kpis.utilization(src.flights, src.maintenance, src.aircraft_lookup),
        ),
        "reporting": (
            warehouse.reporting(),
            raw_kpis.reporting(src.flights, src.postflightreports, src.aircraft_lookup),
        ),
        "reporting per role": (
            warehouse.reporting_per_role(),
            raw_kpis.upper_roles(raw_kpis.reporting(src.flights, src.postflightreports, src.aircraft_lookup, True)),
        ),
    }
    for title, (stored, raw) in pairs.items():
        # Rows per manufacturer and year: kept until the difference is shown, so that neither side is computed again.
        stored, raw = stored.persist(), raw.persist()
        show_timed(f"{title}, warehouse", stored)
        show_timed(f"{title}, source tables", raw)
        show_timed(f"{title}, difference", reconcile(stored, raw))
        stored.unpersist()
        raw.unpersist()


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("hangarline").getOrCreate()
    if args.command == "clean":
        print("\n".join(Warehouse.open(spark, args.warehouse).remove_older_runs()))
        return
    src = sources(spark, args)
    if args.command == "build":
        built = pipeline.run(spark, src, args.warehouse)
        print_rows(built.table("dq_summary").orderBy("item"))
    else:
        compare(Warehouse.open(spark, args.warehouse), src)


if __name__ == "__main__":
    main()
