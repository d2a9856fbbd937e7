"""The batch run over files: raw tables in, stage tables and the cube out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions.parse import parse_day
from stormgrid.plans.calls import clean_calls, daily_incidents
from stormgrid.plans.panel import build_features, build_panel
from stormgrid.plans.profile import StageLog
from stormgrid.plans.risk import RiskRun, train_and_score, write_cube
from stormgrid.plans.weather import (
    POINT, REGION_CELL, clean_weather, located_points, weather_from_payloads,
)
from stormgrid.sources.payload import PROBLEMS, rescue_payloads
from stormgrid.sources.regions import read_regions
from stormgrid.sources.tables import read_csv, write_table


def prepare(
    spark: SparkSession,
    weather_csv: str,
    calls_csv: str,
    regions_geojson: str,
    out: str,
    calls_encoding: str = "ISO-8859-1",
    cell: float = REGION_CELL,
    multi_line: bool = False,
    day_formats: Sequence[str] = D.DAY_FORMATS,
) -> DataFrame:
    """Raw files to the feature table; every stage is kept as Parquet under ``out``.

    ``out/profile`` has the counts of every stage (stage, metric, column, value), taken while the
    stages were written.
    """
    log = StageLog(spark)
    regions = read_regions(spark, regions_geojson)
    # Text files are parsed once; what follows reads the rows twice.
    raw = log.written(read_csv(spark, weather_csv, multi_line=multi_line), f"{out}/weather_raw", "weather_raw")
    weather = log.written(clean_weather(raw, regions, cell), f"{out}/weather_clean", "weather_clean")
    return _features(log, weather, calls_csv, out, calls_encoding, multi_line, day_formats)


def prepare_from_payloads(
    spark: SparkSession,
    payload_json: str,
    calls_csv: str,
    regions_geojson: str,
    out: str,
    calls_encoding: str = "ISO-8859-1",
    cell: float = REGION_CELL,
    multi_line: bool = False,
    day_formats: Sequence[str] = D.DAY_FORMATS,
) -> DataFrame:
    """As ``prepare``, with the weather from payload documents of the points inside a region.

    Documents that cannot be used are kept with what is wrong with them under ``out/payloads_lost``
    and counted in ``out/profile``; text where a number belongs is read as that number.
    """
    log = StageLog(spark)
    regions = read_regions(spark, regions_geojson)
    # Documents are parsed once; what follows reads them twice.
    problems = {
        ("lost", p): F.count_if(F.col("problem") == p) for p in PROBLEMS
    } | {("unread", "values"): F.coalesce(F.sum("unread"), F.lit(0))}
    payloads = log.written(
        rescue_payloads(spark, payload_json, multi_line), f"{out}/payloads", "payloads", more=problems, every_column=False)
    write_table(payloads.filter(F.col("problem").isNotNull()).select("source", "problem", "document"), f"{out}/payloads_lost")
    payloads = payloads.filter(F.col("problem").isNull())
    points = located_points(payloads, regions, cell)
    raw = log.written(weather_from_payloads(payloads, points), f"{out}/weather_raw", "weather_raw")
    weather = log.written(clean_weather(raw, regions, cell), f"{out}/weather_clean", "weather_clean")
    return _features(log, weather, calls_csv, out, calls_encoding, multi_line, day_formats)


def _features(
    log: StageLog, weather: DataFrame, calls_csv: str, out: str, calls_encoding: str,
    multi_line: bool, day_formats: Sequence[str],
) -> DataFrame:
    raw_calls = read_csv(log.spark, calls_csv, encoding=calls_encoding, multi_line=multi_line)
    if "fecha_creacion" in raw_calls.columns:  # otherwise cleaning says what is missing
        unread = F.count_if(parse_day(F.col("fecha_creacion"), day_formats).isNull())
        raw_calls = log.watch(raw_calls, "calls_raw", more={("unread", "fecha_creacion"): unread}, every_column=False)
    calls = log.written(clean_calls(raw_calls, day_formats=day_formats), f"{out}/calls_clean", "calls_clean")
    incidents = log.written(daily_incidents(calls), f"{out}/incidents_daily", "incidents_daily")
    panel = log.written(build_panel(weather, incidents, normalized=True), f"{out}/panel", "panel")
    features = log.written(build_features(panel), f"{out}/features", "features")
    write_table(log.table().coalesce(1), f"{out}/profile")
    return features


def evaluate(features: DataFrame, out: str) -> RiskRun:
    """Train and score, keep the predictions as CSV and Parquet, and write the cube."""
    run = train_and_score(features, ordered=False)
    log = StageLog(features.sparkSession)
    predictions = log.written(run.predictions, f"{out}/predictions", "predictions")
    write_table(log.table().coalesce(1), f"{out}/profile_predictions")
    write_table(predictions, f"{out}/predictions_csv", fmt="csv")
    write_cube(predictions, f"{out}/cube", "probabilidad_lluvia_intensa")
    return replace(run, predictions=predictions)
