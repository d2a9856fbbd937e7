"""Weather: from raw point-days (or payloads) to clean point-days with a region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions.parse import parse_ymd
from stormgrid.functions.text import normalize_key
from stormgrid.operators.clean import drop_null, mask_sentinel, numbers
from stormgrid.operators.columns import present, rename, require_columns
from stormgrid.operators.joins import attach, keep_known
from stormgrid.operators.scale import SLICE_ROWS, row_hash
from stormgrid.operators.series import fill
from stormgrid.operators.spatial import spatial_join
from stormgrid.session import materialize
from stormgrid.sources.payload import explode_parameters

REGION_CELL = 0.05
POINT = ["lat", "lon"]


def located_points(points: DataFrame, regions: DataFrame, cell: float = REGION_CELL) -> DataFrame:
    """(lat, lon, alcaldia) of the distinct points inside some region.

    Points are made distinct before the polygon test: a point occurs once per day.
    The result is small next to its source and is read twice (size check, join),
    so it is written once.
    """
    spots = points.select(*POINT).distinct()
    return materialize(spatial_join(spots, regions, "lat", "lon", cell))


def weather_from_payloads(payloads: DataFrame, points: DataFrame) -> DataFrame:
    """Raw point-days with region from payload documents and located points."""
    rows = explode_parameters(attach(payloads, points, POINT))
    return rows.select("fecha", *POINT, "alcaldia", *D.WEATHER_MEASURES)


def typed_weather(raw: DataFrame, regions: DataFrame, cell: float = REGION_CELL) -> DataFrame:
    """Rows inside a region, with dates, numeric measures and a normalised region.

    Rows without a readable position are dropped.  Sentinels are not masked yet.
    """
    named = require_columns(rename(raw, D.WEATHER_CODES), D.WEATHER_REQUIRED, "weather table")
    named = drop_null(numbers(named, POINT), POINT)  # files bring coordinates as text
    inside = located_points(named, regions, cell)
    if "alcaldia" in named.columns:
        rows = keep_known(named, inside, POINT)
        rows = rows.withColumn("alcaldia", normalize_key(F.col("alcaldia")))
    else:
        # The region comes from the small table of points: normalise it there, once.
        rows = attach(named, inside.withColumn("alcaldia", normalize_key(F.col("alcaldia"))), POINT)
    rows = drop_null(rows.withColumn("fecha", parse_ymd(F.col("fecha"))), ["fecha"])
    return numbers(rows, present(rows, D.WEATHER_MEASURES))


def clean_weather(
    raw: DataFrame,
    regions: DataFrame,
    cell: float = REGION_CELL,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """Typed, sentinel-free, gap-filled point-days with a normalised region.

    The fill runs per point.  ``slice_rows=None`` saves its count of rows per point;
    use it where a point is known to have one row per day.
    """
    typed = typed_weather(raw, regions, cell)
    measures = present(typed, D.WEATHER_MEASURES)
    masked = mask_sentinel(typed, measures)
    # A point may have a day twice: a hash of the row settles which comes first.
    tied = masked.withColumn("_tie", row_hash(masked))
    filled = fill(tied, POINT, ["fecha", "_tie"], measures, slice_rows).drop("_tie")
    return drop_null(filled, ["alcaldia"])
