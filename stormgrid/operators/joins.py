"""Equality joins on region, day and point keys."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.operators.columns import ensure_columns
from stormgrid.operators.scale import LOOKUP_BYTES, lookup_join
from stormgrid.session import materialize


def keep_known(
    df: DataFrame, keys_df: DataFrame, keys: Sequence[str], max_bytes: int = LOOKUP_BYTES
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df``; no columns are added."""
    keys = list(keys)
    return lookup_join(df, keys_df.select(*keys).distinct(), keys, "left_semi", max_bytes)


def attach(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], max_bytes: int = LOOKUP_BYTES
) -> DataFrame:
    """Inner join with a lookup table that has one row per key."""
    return lookup_join(df, dim, keys, "inner", max_bytes)


def fold_values(
    df: DataFrame, folds: Mapping[str, Callable[[Column], Column]], max_bytes: int = LOOKUP_BYTES
) -> DataFrame:
    """Replace text columns by a function of them, computed once per distinct value.

    The distinct values of all columns are found in one scan with partial aggregation and written
    with their folded form; rows then meet them through the measured lookup, so a column of few
    values costs a hash lookup a row however dear the function is.  Nulls are folded too.
    """
    columns = df.columns
    values = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(folds)])
    found = df.select(F.inline(values)).filter(F.col("_v").isNotNull()).distinct()
    folded = F.coalesce(*[F.when(F.col("_i") == i, fold(F.col("_v"))) for i, fold in enumerate(folds.values())])
    found = materialize(found.withColumn("_f", folded))
    for i, (c, fold) in enumerate(folds.items()):
        own = found.filter(F.col("_i") == i).select(F.col("_v").alias(c), F.col("_f").alias(f"_{i}"))
        df = lookup_join(df.withColumn(c, F.col(c).cast("string")), own, [c], "left", max_bytes)
        nothing = fold(F.lit(None).cast("string"))
        df = df.withColumn(c, F.when(F.col(c).isNull(), nothing).otherwise(F.col(f"_{i}"))).drop(f"_{i}")
    return df.select(*columns)


def left_zero(
    df: DataFrame, other: DataFrame, keys: Sequence[str], fill_cols: Sequence[str]
) -> DataFrame:
    """Left join of two tables that are unique on ``keys``; absent counts become 0.

    Both sides are already aggregated to the key, so no key can be hot and the
    join reuses the hash partitioning of the aggregations.
    """
    fill_cols = list(fill_cols)
    joined = ensure_columns(df.join(other, list(keys), "left"), fill_cols)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in fill_cols})


def style(
    regions: DataFrame,
    slice_df: DataFrame,
    key: str,
    palette: Mapping[str, str] = D.PALETTE,
    no_data: str = D.NO_DATA_COLOR,
    risk: str = "riesgo",
) -> DataFrame:
    """Every region with the fill of its risk class, or the no-data fill.

    Both sides have one row per region, so the join needs neither hint nor salt.
    """
    known = slice_df.select(key, F.col(risk), F.lit(True).alias("_hit"))
    colors = F.create_map(*[F.lit(x) for pair in palette.items() for x in pair])
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (
        regions.join(known, [key], "left")
        .withColumns({
            "fill_color": F.when(
                hit, F.coalesce(F.try_element_at(colors, F.col(risk)), F.lit(D.UNKNOWN_RISK_COLOR))
            ).otherwise(F.lit(no_data)),
            "fill_opacity": F.when(hit, F.lit(D.DATA_OPACITY)).otherwise(D.NO_DATA_OPACITY),
            "border_color": F.lit(D.BORDER_COLOR),
            "border_width": F.lit(D.BORDER_WIDTH),
        })
        .drop("_hit")
    )
