"""Helpers that the operators share: written intermediate tables and text batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. Local sessions that leave it unset get a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = "file://" + tempfile.mkdtemp(prefix="hangarline-llm-")
    return _LOCAL_FOLDERS[app]


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not have, whatever its columns are called."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def shards_for(rows: int, rows_per_shard: int) -> int:
    """How many shards keep the expected rows of a shard at or under the given number."""
    return max(1, -(-rows // rows_per_shard))


def text_parts(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts of an array of texts into slices of at most so many bytes, or of one longer text: first and after.

    Batches are bounded in rows; with this a task's working memory is bounded in bytes too.
    """
    yield from size_parts(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), limit)


def size_parts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """The same cuts by the sizes of the texts alone."""
    before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(before, before[low] + limit, side="right")) - 1)
        yield low, high
        low = high


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that jobs need no --py-files."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="hangarline-code-")
    with zipfile.ZipFile(f"{folder}/hangarline_code.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted((root / "hangarline").rglob("*.py")):
            archive.write(file, file.relative_to(root))
    context.addPyFile(f"{folder}/hangarline_code.zip")
    _SHIPPED.add(context.applicationId)
