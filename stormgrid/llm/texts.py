"""Small helpers the text operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import stormgrid
from stormgrid.session import table_path

#: Rows handed back to Spark at a time; bounds what a task holds besides its input batch.
SLICE = 512


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python once a session, in case they have no copy."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(stormgrid.__file__)))
        path = os.path.join(tempfile.mkdtemp(), "stormgrid")
        context.addPyFile(shutil.make_archive(path, "zip", root, "stormgrid"))
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table below the shared folder: smaller than a checkpoint, and columnar."""
    path = table_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hashed_sample(df: DataFrame, at: Column, rows: int) -> DataFrame:
    """Up to so many rows, those first by the hash ``at``.

    Rows are counted first and only about four times as many as wanted pass a threshold, so what
    tasks send to be merged does not grow with their number.
    """
    share = 4 * rows / max(1, df.count())
    found = df.withColumn("_at", at)
    if share < 1:
        found = found.filter(F.pmod("_at", F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return found.orderBy("_at").limit(rows).drop("_at")


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; null counts as empty."""
    return [v or "" for v in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and where each text starts (one more than rows)."""
    column = pa.array(column.to_pylist(), pa.large_binary()) if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]
