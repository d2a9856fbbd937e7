"""Regular grids of sampling points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _steps(low: float, high: float, step: float) -> int:
    return max(0, math.ceil((high - low) / step))


def axis_value(i: Column, low: float, step: float) -> Column:
    """Value number ``i`` of an axis, in the arithmetic of a half-open numeric range."""
    return F.lit(low) + i * F.lit((low + step) - low)


def grid(
    spark: SparkSession, minx: float, maxx: float, miny: float, maxy: float, step: float
) -> DataFrame:
    """(row, col, lat, lon) for every point of ``[min, max)`` on both axes.

    Row and column are exact integer keys; join on them rather than on the
    coordinates.  One range is split arithmetically, there is no cross join.
    """
    n_rows, n_cols = _steps(miny, maxy, step), _steps(minx, maxx, step)
    ids = spark.range(n_rows * n_cols)
    at = ids.select(
        F.floor(F.col("id") / n_cols).cast("int").alias("row"),
        F.pmod(F.col("id"), F.lit(n_cols)).cast("int").alias("col"),
    ) if n_cols else ids.select(F.lit(0).alias("row"), F.lit(0).alias("col"))
    return at.select(
        "row", "col",
        axis_value(F.col("row"), miny, step).alias("lat"),
        axis_value(F.col("col"), minx, step).alias("lon"),
    )
