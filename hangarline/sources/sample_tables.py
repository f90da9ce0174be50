"""Presents the generated star-schema tables as airline source tables.

Only `supplier`, `lineitem`, `orders` and `events` are read. The mapping deliberately yields swapped
times, overlapping flights, missing arrivals, cancellations and unknown aircraft.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hangarline.sources.tables import SourceTables

POSTFLIGHT_EVENTS = ("click", "view", "error")

# The columns used. Declaring them spares a look at the files before every query.
COLUMNS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, user_id bigint, event_type string",
}


def sample_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    def read(name: str) -> DataFrame:
        return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")

    def fleet() -> Column:
        """Number of suppliers as a scalar subquery: one number, no join."""
        return read("supplier").agg(F.count("*")).scalar()

    def reports(from_postflight: bool) -> DataFrame:
        postflight = F.coalesce(F.col("event_type").isin(*POSTFLIGHT_EVENTS), F.lit(False))
        rows = read("events").where(postflight if from_postflight else ~postflight)
        return rows.select(
            F.col("user_id").alias("reporteurid"),
            _aircraft(F.col("event_id") % fleet()),
            # Event years lie outside the flight years, so the day is made from the id.
            F.expr("date_add(DATE '1995-01-01', CAST(event_id * 37 % 2400 AS INT))").alias("reportingdate"),
            F.expr("CASE WHEN user_id % 2 = 0 THEN 'pirep' ELSE 'marep' END").alias("reporteurclass"),
        )

    readers = {
        "flights": lambda: _flights(read("lineitem")),
        "maintenance": lambda: _maintenance(read("orders"), fleet()),
        "workorders": lambda: read("orders").select(_aircraft(F.col("o_custkey") % fleet(), prefix=" ac-")),
        "maintenanceevents": lambda: read("events").select(_aircraft(F.col("user_id") % (fleet() + 5))),
        "postflightreports": lambda: reports(True),
        "technicallogbookorders": lambda: reports(False),
        "aircraft_lookup": lambda: _lookup(read("supplier")),
        "personnel": lambda: _personnel(read("events")),
    }
    return SourceTables(readers)


def _aircraft(number: Column, prefix: str = "AC-") -> Column:
    return F.concat(F.lit(prefix), number.cast("string")).alias("aircraftregistration")


def _flights(lineitem: DataFrame) -> DataFrame:
    # Minutes after midnight of the ship day; one timestamp addition per column at the end.
    minutes = lineitem.selectExpr(
        "l_suppkey",
        "l_shipdate",
        "(l_partkey % 24) * 60 AS departs",
        "CAST(l_quantity AS INT) * 30 AS lasts",
        "(l_partkey % 24) * 60 + l_linenumber * 5 AS off",
        "CASE WHEN l_orderkey % 97 <> 0 THEN (l_partkey % 24) * 60 + l_linenumber * 5 + CAST(l_quantity AS INT) * 30"
        " + (CAST(round(l_discount * 100) AS INT) - 5) * 10 END AS landed",
        "l_orderkey % 50 = 0 AS entered_backwards",
        "l_returnflag = 'R' AND l_orderkey % 10 = 0 AS cancelled",
    )

    def moment(minute: str, name: str) -> Column:
        return F.expr(f"timestampadd(MINUTE, {minute}, l_shipdate)").alias(name)

    return minutes.select(
        _aircraft(F.col("l_suppkey")),
        moment("departs", "scheduleddeparture"),
        moment("departs + lasts", "scheduledarrival"),
        moment("IF(entered_backwards, coalesce(landed, off), off)", "actualdeparture"),
        moment("IF(entered_backwards, off, landed)", "actualarrival"),
        "cancelled",
    )


def _maintenance(orders: DataFrame, fleet: Column) -> DataFrame:
    start = "timestampadd(MINUTE, (o_custkey % 24) * 60, o_orderdate)"
    return orders.select(
        _aircraft(F.col("o_orderkey") % fleet),
        F.expr(start).alias("scheduleddeparture"),
        F.expr(f"timestampadd(MINUTE, (o_custkey % 5) * 1440 + 300, {start})").alias("scheduledarrival"),
        F.expr("o_orderpriority <> '1-URGENT'").alias("programmed"),
    )


def _lookup(supplier: DataFrame) -> DataFrame:
    return supplier.where("s_suppkey % 10 <> 9").selectExpr(
        "concat(' ac-', s_suppkey, ' ') AS aircraft_reg_code",
        "s_name AS manufacturer_serial_number",
        "concat('M', s_nationkey % 7) AS aircraft_model",
        "CASE WHEN s_nationkey % 2 = 0 THEN 'Airbus' ELSE 'Boeing' END AS aircraft_manufacturer",
    )


def _personnel(events: DataFrame) -> DataFrame:
    reporters = events.where("user_id % 2 = 1").select("user_id").distinct()
    return reporters.selectExpr(
        "user_id AS reporteurid",
        "concat('A', lpad(CAST(user_id % 20 AS STRING), 2, '0')) AS airport",
    )
