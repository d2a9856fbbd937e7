"""Validation tables of the stages: counted while a stage is written, or from its rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.sources.tables import write_table


def stage_profile(df: DataFrame, region: str = "alcaldia", day: str = "fecha") -> DataFrame:
    """(metric, column, value) as text: shape, missing values, totals, regions, days.

    Everything is one aggregation; counts, sums and extremes combine before the
    shuffle and the distinct count of regions deduplicates there too.
    """
    numeric = [c for c, kind in df.dtypes if kind in ("int", "bigint")]
    cells = [("rows", "", F.count(F.lit(1))), ("columns", "", F.lit(len(df.columns)))]
    cells += [("nulls", c, F.count_if(F.col(c).isNull())) for c in df.columns]
    cells += [("total", c, F.coalesce(F.sum(c), F.lit(0))) for c in numeric]
    if region in df.columns:
        cells.append(("distinct", region, F.count_distinct(region)))
    if day in df.columns:
        cells += [("min", day, F.min(day)), ("max", day, F.max(day))]
    wide = df.agg(*[v.cast("string").alias(f"v{i}") for i, (_, _, v) in enumerate(cells)])
    lines = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(column).alias("column"),
            F.col(f"v{i}").alias("value"),
        )
        for i, (metric, column, _) in enumerate(cells)
    ]
    return wide.select(F.inline(F.array(*lines)))


class StageLog:
    """Counts of stages, taken by the jobs that write them.

    ``watch`` hangs counts on a frame; they are ready once a job has run over it.  A frame is to be
    watched where no shuffle follows before its write: Spark counts a task of the last stage once,
    however often an executor is lost, but may count a task before a shuffle twice.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._watched: list[tuple[str, list[tuple[str, str]], Observation]] = []

    def watch(
        self, df: DataFrame, stage: str, day: str = "fecha", more: Mapping[tuple[str, str], Column] | None = None,
        every_column: bool = True,
    ) -> DataFrame:
        """``df`` with counts: rows, columns, missing values, totals of whole numbers, first and last day,
        values at or below the sentinel limit, and ``more``, named (metric, column)."""
        cells: dict[tuple[str, str], Column] = {("rows", ""): F.count(F.lit(1))}
        if every_column:
            kinds = df.dtypes
            cells["columns", ""] = F.max(F.lit(len(kinds)))
            cells |= {("nulls", c): F.count_if(F.col(c).isNull()) for c, _ in kinds}
            cells |= {("total", c): F.coalesce(F.sum(c), F.lit(0)) for c, kind in kinds if kind in ("int", "bigint")}
            cells |= {
                ("invalid", c): F.count_if(F.col(c) <= F.lit(D.SENTINEL_LIMIT))
                for c, kind in kinds if kind == "double" and c in D.WEATHER_MEASURES
            }
            if day in df.columns:
                cells |= {("min", day): F.min(day), ("max", day): F.max(day)}
        cells |= dict(more or {})
        seen = Observation()
        self._watched.append((stage, list(cells), seen))
        return df.observe(seen, *[v.cast("string").alias(f"v{i}") for i, v in enumerate(cells.values())])

    def written(self, df: DataFrame, path: str, stage: str, **watched) -> DataFrame:
        """Write a stage with its counts and go on from the written table, so later stages never redo it."""
        write_table(self.watch(df, stage, **watched), path)
        return self.spark.read.parquet(path)

    def table(self) -> DataFrame:
        """(stage, metric, column, value) of all stages watched; waits for jobs that have not ended."""
        lines = [
            (stage, metric, column, seen.get[f"v{i}"])
            for stage, cells, seen in self._watched for i, (metric, column) in enumerate(cells)
        ]
        return self.spark.createDataFrame(lines, "stage string, metric string, column string, value string")
