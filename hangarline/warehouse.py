"""The published warehouse: parquet tables of one run, found through numbered publications.

    <root>/runs/<run_id>/<table>/       tables of a run; facts are partitioned by year
    <root>/publications/<number>        the id of a published run; the largest number is the current one

A run writes into its own folder and is published last, so readers see either the whole new run or the previous one.
Its id holds the number of the publication it started after, and it can only become the next one: of two builds at once
one is published and the other one told so. That also says which runs can be removed: those whose turn is over, never
one that may still be published. Earlier runs are left alone by the build; `remove_older_runs` removes them.
"""

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hangarline import schemas
from hangarline.files import Files
from hangarline.plans import kpis


class PublicationConflict(RuntimeError):
    """Another build was published since this one started."""


def _publications(spark: SparkSession, root: str) -> Files:
    return Files(spark, f"{root.rstrip('/')}/publications")


def _numbers(publications: Files) -> list[int]:
    return [int(name) for name in publications.names() if name.isdigit()]


def _started_after(run_id: str) -> int | None:
    """The number of the publication a run started after; None for folders that no build made."""
    found = re.fullmatch(r"[^-]+-after(\d+)-[0-9a-f]+", run_id)
    return int(found[1]) if found else None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run_id = run_id

    @classmethod
    def new_run(cls, spark: SparkSession, root: str) -> "Warehouse":
        started = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
        last = max(_numbers(_publications(spark, root)), default=0)
        return cls(spark, root, f"{started}-after{last}-{uuid.uuid4().hex[:8]}")

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "Warehouse":
        """The latest published run. A publication that was begun and not written counts as none."""
        publications = _publications(spark, root)
        for number in sorted(_numbers(publications), reverse=True):
            if run_id := publications.text(f"{number:010d}").strip():
                return cls(spark, root, run_id)
        raise FileNotFoundError(f"no published warehouse in {root}")

    def path(self, table: str) -> str:
        return f"{self.root}/runs/{self.run_id}/{table}"

    def table(self, name: str) -> DataFrame:
        """Facts come with their `year` partition column, which filters can prune by."""
        spec = schemas.TABLES.get(name)
        if spec is None:
            return self.spark.read.parquet(self.path(name))
        stored = T.StructType([*spec.schema.fields, T.StructField("year", T.IntegerType())])
        return self.spark.read.schema(stored if spec in schemas.FACTS else spec.schema).parquet(self.path(name))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in schemas.TABLES}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table and returns what was written.

        Declared tables get exactly their declared columns. Facts are partitioned by year; the
        rebalance lets AQE merge small and split large years into files of a sensible size.
        """
        spec = schemas.TABLES.get(name)
        if spec is None:
            df.write.parquet(self.path(name))
        elif spec in schemas.FACTS:
            rows = spec.conform(df)
            rows = rows.withColumn("year", schemas.year_of(rows)).hint("rebalance", "year")
            rows.write.partitionBy("year").parquet(self.path(name))
        else:
            spec.conform(df).hint("rebalance").write.parquet(self.path(name))
        return self.table(name)

    def publish(self) -> None:
        """Makes this run the current one, or raises if another run took that place since this one started."""
        number = (_started_after(self.run_id) or 0) + 1
        if not _publications(self.spark, self.root).create(f"{number:010d}", self.run_id):
            raise PublicationConflict(f"{self.run_id}: publication {number} is taken; build again on top of it")

    def remove(self, table: str) -> None:
        """Removes one table of this run."""
        Files(self.spark, f"{self.root}/runs/{self.run_id}").remove(table)

    def remove_older_runs(self) -> list[str]:
        """Removes the runs that started before this one and are not, and cannot become, the current one; returns their ids.

        A run that failed looks like one that is still being built, and stays until the next publication ends its turn.
        Nobody may be reading the removed runs.
        """
        last = max(_numbers(_publications(self.spark, self.root)), default=0)
        runs = Files(self.spark, f"{self.root}/runs")
        older = []
        for run_id in runs.names():
            after = _started_after(run_id)
            if run_id < self.run_id and (after is None or after < last):
                runs.remove(run_id)
                older.append(run_id)
        return older

    def utilization(self) -> DataFrame:
        return kpis.utilization(self.table("flights"), self.table("unavailability"), self.table("aircraft"))

    def reporting(self) -> DataFrame:
        return kpis.reporting(self.table("reports"), self.table("flights"), self.table("aircraft"))

    def reporting_per_role(self) -> DataFrame:
        return kpis.reporting(self.table("reports"), self.table("flights"), self.table("aircraft"), per_role=True)


@contextmanager
def temp_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[SparkSession]:
    """Makes tables available to `spark.sql` by name for the length of a `with` block."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        yield spark
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
