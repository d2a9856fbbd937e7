"""Emergency calls: from raw records to confirmed incidents and daily counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.functions.parse import parse_day, to_number
from stormgrid.functions.text import normalize_key, normalize_text
from stormgrid.operators.aggregate import crosstab
from stormgrid.operators.clean import (
    drop_null, keep_bbox, keep_nonempty, keep_values,
)
from stormgrid.operators.columns import (
    any_positive, clean_names, ensure_columns, rename, require_columns, row_sum,
)


def clean_calls(
    raw: DataFrame,
    types: Sequence[str] = D.INCIDENT_TYPES,
    codes: Sequence[str] = D.CONFIRMED_CODES,
    day_formats: Sequence[str] = D.DAY_FORMATS,
) -> DataFrame:
    """Confirmed calls of the given types, inside the box, with day and region.

    Type and code are tested first: they discard most rows before any date or
    coordinate is parsed.  ``day_formats`` are tried in order; a day that fits none
    drops the row, so name the file's own format first where it differs
    (``["d/M/yyyy H:mm:ss", *DAY_FORMATS]`` for day-first files).
    """
    require_columns(raw, D.CALL_REQUIRED, "call table")
    rows = _once(raw.select(*D.CALL_REQUIRED), {
        "incidente_c4": normalize_text(F.col("incidente_c4")),
        "codigo_cierre": normalize_text(F.col("codigo_cierre").cast("string")),
    })
    rows = keep_values(keep_values(rows, "incidente_c4", types), "codigo_cierre", codes)
    rows = _once(rows, {
        "fecha": parse_day(F.col("fecha_creacion"), day_formats),
        "alcaldia_cierre": normalize_key(F.col("alcaldia_cierre")),
        "latitud": to_number(F.col("latitud")),
        "longitud": to_number(F.col("longitud")),
    })
    rows = drop_null(rows, ["fecha", "latitud", "longitud", "alcaldia_cierre"])
    rows = keep_nonempty(keep_bbox(rows, "latitud", "longitud"), "alcaldia_cierre")
    return rename(rows, D.CALL_RENAMES).select(
        "id_incidente", "fecha", "alcaldia", "latitud", "longitud", "tipo_incidente",
        "codigo_cierre",
    )


def _once(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` behind a generator: later filters use the values instead of
    copies of the expressions, so each is computed once a row."""
    kept = [c for c in df.columns if c not in values]
    row = F.struct(*kept, *[v.alias(c) for c, v in values.items()])
    return df.select(F.inline(F.array(row)))


def unread_days(raw: DataFrame, day_formats: Sequence[str] = D.DAY_FORMATS) -> DataFrame:
    """One row (rows, unread): calls, and those whose day fits no format."""
    day = parse_day(F.col("fecha_creacion"), day_formats)
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(day.isNull()).alias("unread"))


def daily_incidents(calls: DataFrame, types: Sequence[str] = D.INCIDENT_TYPES) -> DataFrame:
    """Counts per type for each (day, region), their total and two flags."""
    counts = crosstab(calls, ["fecha", "alcaldia"], "tipo_incidente", types)
    counts = ensure_columns(rename(clean_names(counts), D.INCIDENT_RENAMES), D.INCIDENT_COLUMNS)
    summed = row_sum(counts, D.INCIDENT_COLUMNS, "total_incidentes")
    flagged = any_positive(summed, {
        "hubo_inundacion": ["inundacion"],
        "hubo_incidente_hidrico": D.INCIDENT_COLUMNS,
    })
    return flagged.select(
        "fecha", "alcaldia",
        *[F.col(c).cast("int").alias(c) for c in [*D.INCIDENT_COLUMNS, *D.INCIDENT_TOTALS]],
    )
