"""Session settings the operators are written for."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("stormgrid")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for intermediate tables.

    A session on one machine may name none; it then gets a temporary folder that is
    removed when the process ends.  On a cluster that is refused, since executors
    would not see the folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("name the shared folder in spark.checkpoint.dir")
    folder = tempfile.mkdtemp(prefix="stormgrid-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written once and the lineage is cut.

    Used where a frame feeds several actions (fit, tune, score), so that a lost
    executor costs a re-read instead of the whole upstream graph.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
