"""Serving tables: dimensions, the risk fact, and reads by day."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions.parse import to_int, to_number, to_upper
from stormgrid.functions.text import normalize_ascii
from stormgrid.operators.aggregate import bounds
from stormgrid.operators.joins import style


def dim_time(df: DataFrame, date_col: str = "fecha") -> DataFrame:
    """Distinct days with their calendar parts."""
    d = F.col(date_col)
    return df.select(d.cast("date").alias("fecha")).dropna().distinct().select(
        "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        F.dayofmonth("fecha").alias("dia"),
    )


def dim_region(df: DataFrame, region_col: str = "alcaldia") -> DataFrame:
    """Distinct serving keys of the region names."""
    return df.select(F.col(region_col)).distinct().select(
        normalize_ascii(F.col(region_col)).alias("alcaldia")
    ).distinct()


def typed_metrics(df: DataFrame) -> DataFrame:
    """Score columns under their serving names and types."""
    return df.withColumns({
        "probabilidad": to_number(F.col("probabilidad_lluvia_intensa")),
        "prediccion": to_int(F.col("prediccion_lluvia_intensa")),
        "valor_real": to_int(F.col("valor_real")),
        "riesgo": to_upper(F.col("riesgo")),
    }).drop("probabilidad_lluvia_intensa", "prediccion_lluvia_intensa")


def fact_risk(df: DataFrame, order_col: str | Sequence[str]) -> DataFrame:
    """One typed row per (day, region); the row highest in ``order_col`` wins.

    ``max_by`` keeps one row per key and task before the shuffle, so repeated
    keys do not travel.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    metrics = ["probabilidad", "prediccion", "valor_real", "riesgo"]
    keyed = df.withColumns({
        "fecha": F.col("fecha").cast("date"),
        "alcaldia": normalize_ascii(F.col("alcaldia")),
        "_at": F.struct(*order),
    })
    latest = (
        typed_metrics(keyed).groupBy("fecha", "alcaldia")
        .agg(F.max_by(F.struct(*metrics), F.col("_at")).alias("m"))
    )
    return latest.select(
        "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        F.dayofmonth("fecha").alias("dia"), "alcaldia", *[f"m.{c}" for c in metrics],
    )


def date_range(fact: DataFrame) -> DataFrame:
    return bounds(fact, "fecha")


def slice_by_date(fact: DataFrame, d: datetime.date | str) -> DataFrame:
    """The regions of one day; on a date-partitioned fact this reads one folder."""
    return fact.filter(F.col("fecha") == F.lit(str(d)).cast("date")).select(
        "alcaldia", "probabilidad", "prediccion", "valor_real", "riesgo"
    )


def ranked(fact: DataFrame, d: datetime.date | str) -> DataFrame:
    """(alcaldia, probabilidad, riesgo) of one day, highest probability first."""
    return slice_by_date(fact, d).select("alcaldia", "probabilidad", "riesgo").orderBy(
        F.desc("probabilidad"), "alcaldia"
    )


def region_features(
    regions: DataFrame,
    fact: DataFrame,
    d: datetime.date | str,
    palette: Mapping[str, str] = D.PALETTE,
    name: str = "NOMGEO",
) -> DataFrame:
    """One row per region with names, style and its GeoJSON feature text."""
    named = regions.select(
        normalize_ascii(F.col(name)).alias("alcaldia"),
        F.col(name).alias("display_name"),
        "geometry",
    )
    properties = F.to_json(F.struct(F.col("alcaldia").alias("name"), "display_name"))
    return style(named, slice_by_date(fact, d), "alcaldia", palette).select(
        F.col("alcaldia").alias("name"), "display_name", "riesgo", "fill_color", "fill_opacity",
        "border_color", "border_width",
        F.concat(
            F.lit('{"type":"Feature","properties":'), properties,
            F.lit(',"geometry":'), F.col("geometry"), F.lit("}"),
        ).alias("feature"),
    )
