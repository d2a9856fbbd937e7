"""Incremental landing of weather payload files.

The safety copy taken every hundred points becomes a file stream: each
micro-batch takes at most that many payload files, appends their rows to a
Parquet table, and records its progress.  A restart continues after the last
finished batch; nothing already landed is read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stormgrid.session import materialize
from stormgrid.sources.payload import PAYLOAD_SCHEMA, explode_parameters, with_payload
from stormgrid.sources.tables import land_batch

FILES_PER_BATCH = 100
#: Degrees of a tile, the unit of the landed table that a batch rewrites.
TILE = 1.0


def land_payloads(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    files_per_batch: int = FILES_PER_BATCH,
    multi_line: bool = True,
) -> StreamingQuery:
    """Land everything now in ``source``; returns the started query.

    The source is a folder of JSON payloads, one point per file (or per line with
    ``multi_line=False``).  ``progress`` belongs in shared storage next to
    ``target``.
    """
    payloads = (
        spark.readStream.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch).json(source)
    )
    return (
        explode_parameters(payloads).writeStream.format("parquet")
        .option("path", target).option("checkpointLocation", progress)
        .outputMode("append").trigger(availableNow=True).start()
    )


def land_latest(
    spark: SparkSession,
    source: str,
    target: str,
    lost: str,
    progress: str,
    files_per_batch: int = FILES_PER_BATCH,
    multi_line: bool = True,
    tile: float = TILE,
) -> StreamingQuery:
    """As ``land_payloads``, but a point that arrives again replaces the rows it had.

    The table is partitioned by tiles.  A batch rewrites the tiles it has points in: their rows of
    other points and the batch's own rows, of each point those of its newest file.  Doing a batch
    again, as after a failure, gives the same table.  Documents that cannot be used are kept under
    ``lost`` by batch.
    """
    text = (
        spark.readStream.format("text").option("wholetext", multi_line)
        .option("maxFilesPerTrigger", files_per_batch).load(source)
        .select("value", F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("source"))
    )
    return (
        text.filter(F.trim("value") != "").writeStream
        .foreachBatch(lambda batch, number: _merge(batch, number, target, lost, tile))
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )


def _tile(degrees: Column, tile: float) -> Column:
    return F.floor(degrees / F.lit(tile)).cast("int")


def _merge(batch: DataFrame, number: int, target: str, lost: str, tile: float) -> None:
    spark = batch.sparkSession
    # Written once: parsing a batch costs more than the rest of it, and four frames read it.
    kept = F.when(F.col("problem").isNotNull(), F.col("value"))
    found = materialize(with_payload(batch, "value").withColumn("value", kept))
    broken = found.filter(F.col("problem").isNotNull())
    land_batch(broken.select("source", "problem", "value", F.lit(number).alias("batch")), lost, "batch")
    newest = found.filter(F.col("problem").isNull()).groupBy("lat", "lon").agg(
        F.max_by("properties", F.struct("modified", "source")).alias("properties"))
    tiles = {"tile_lat": _tile(F.col("lat"), tile), "tile_lon": _tile(F.col("lon"), tile)}
    rows = explode_parameters(newest).withColumns(tiles)
    try:
        landed = spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        # A batch has a bounded number of files, so its points are few next to the table.
        points = newest.select("lat", "lon")
        touched = points.withColumns(tiles).select("tile_lat", "tile_lon").distinct()
        others = landed.join(touched, ["tile_lat", "tile_lon"], "left_semi").join(points, ["lat", "lon"], "left_anti")
        rows = rows.unionByName(others)
    # By tile and not by point, or each task has a file in every tile; a large tile is split by its bytes.
    (
        rows.hint("rebalance", "tile_lat", "tile_lon").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("tile_lat", "tile_lon").parquet(target)
    )
