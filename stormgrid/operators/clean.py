"""Filters and value repair.  All but ``distinct_by`` are narrow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import defaults as D
from stormgrid.functions.parse import to_number


def keep_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def keep_bbox(df: DataFrame, lat: str, lon: str, box: Mapping = D.CALL_BOX) -> DataFrame:
    """Rows inside the box, borders included."""
    return df.filter(F.col(lat).between(*box["lat"]) & F.col(lon).between(*box["lon"]))


def drop_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def keep_nonempty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) != "")


def numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Coerce each column to double, unusable values to null; only text is parsed."""
    kinds = {f.name: f.dataType for f in df.schema}

    def number(c: str) -> Column:
        value = F.col(c)
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            return F.nanvl(value.cast("double"), F.lit(None).cast("double"))
        return value.cast("double") if isinstance(kinds[c], T.NumericType) else to_number(value)

    return df.withColumns({c: number(c) for c in cols})


def mask_sentinel(
    df: DataFrame, cols: Sequence[str], limit: float = D.SENTINEL_LIMIT
) -> DataFrame:
    """Null out values at or below the sentinel limit."""
    return df.withColumns({c: F.when(F.col(c) > F.lit(limit), F.col(c)) for c in cols})


def zero_fill_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in cols})


def distinct_by(
    df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one lowest in ``order_col``, or any when none is given.

    Both forms aggregate before they shuffle, so copies of one key never meet in
    a single task.
    """
    keys = list(keys)
    if order_col is None:
        return df.dropDuplicates(keys)
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return (
        df.groupBy(*keys).agg(best.alias("_row"))
        .select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )
