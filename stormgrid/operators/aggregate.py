"""Group-bys and profile tables.

Every aggregate here is algebraic, so Spark combines rows before the shuffle and
a key that holds a third of the table costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D


def mean_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of each column per key, nulls skipped, rows with a null key dropped."""
    keys = list(keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def crosstab(
    df: DataFrame, keys: Sequence[str], category: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Counts per category as columns; rows null in a key or the category are dropped.

    It is one hash aggregation of conditional counts.  Without ``values`` the
    distinct categories are listed first; each becomes a column, however many.
    """
    keys = list(keys)
    rows = df.dropna(subset=[*keys, category])
    if values is None:
        found = rows.select(F.col(category).alias("v")).distinct().orderBy("v")
        values = [r["v"] for r in found.toLocalIterator()]
    is_value = [F.count_if(F.col(category) == F.lit(v)).alias(str(v)) for v in values]
    return rows.groupBy(*keys).agg(*is_value)


def crosstab_map(df: DataFrame, keys: Sequence[str], category: str, out: str = "counts") -> DataFrame:
    """Counts per category as one map column (category -> rows); rows null in a key or the category are dropped.

    No list of categories is made anywhere, so there can be any number of them; a row holds those of
    its key.  ``try_element_at(counts, v)`` reads one, null where a key has none.
    """
    keys = list(keys)
    counts = df.dropna(subset=[*keys, category]).groupBy(*keys, category).agg(F.count(F.lit(1)).alias("_n"))
    entries = F.sort_array(F.collect_list(F.struct(category, "_n")))
    return counts.groupBy(*keys).agg(F.map_from_entries(entries).alias(out))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) by falling count, nulls dropped."""
    return (
        df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
    )


def value_share(df: DataFrame, col: str, digits: int | None = None) -> DataFrame:
    """(value, n, pct) by falling count.

    The total is a scalar subquery over the same counts, so the table is read
    once and no window gathers the values in one task.
    """
    counts = df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    pct = F.col("n") / counts.select(F.sum("n").alias("all")).scalar() * 100
    if digits is not None:
        pct = F.round(pct, digits)
    return counts.withColumn("pct", pct).orderBy(F.desc("n"), col)


def rate_by(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Percentage of rows with the flag per group, highest first."""
    return (
        df.dropna(subset=[key]).groupBy(key).agg((F.avg(flag) * 100).alias("pct"))
        .orderBy(F.desc("pct"), key)
    )


def count_distinct_by(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact distinct counts of several columns, global or per group."""
    keys = list(keys)
    rows = df.dropna(subset=keys) if keys else df
    return rows.groupBy(*keys).agg(*[F.count_distinct(c).alias(c + "_distinct") for c in cols])


def count_distinct_whole(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), sparse: int = 64
) -> DataFrame:
    """Exact distinct counts of whole-number columns by bitmaps, global or per group.

    Values of 32,768 in a row share a bitmap of 4 KB, so what is shuffled and held depends on the
    range of a column, not on its rows, and no row is repeated per column.  A column whose range is
    more than ``sparse`` times its values, where bitmaps would be mostly empty, is counted by
    ``count_distinct``; one aggregation over the table tells.
    """
    keys, cols = list(keys), list(cols)
    rows = df.dropna(subset=keys) if keys else df
    spans = rows.agg(*[
        F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.approx_count_distinct(c).alias("n")).alias(c) for c in cols
    ]).first()
    parts = []
    for i, c in enumerate(cols):
        valued = rows.filter(F.col(c).isNotNull())
        span = spans[c]
        if span["n"] and span["high"] - span["low"] > sparse * span["n"]:
            counted = valued.groupBy(*keys).agg(F.count_distinct(c).alias("_n"))
        else:
            value = F.col(c).cast("long")
            bits = valued.groupBy(*keys, F.bitmap_bucket_number(value).alias("_bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("_bits"))
            counted = bits.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias("_n"))
        parts.append(counted.select(*keys, F.lit(i).alias("_i"), "_n"))
    if keys:  # a group without any value still counts, as zero
        parts.append(rows.groupBy(*keys).agg(F.lit(len(cols)).alias("_i"), F.lit(0).cast("long").alias("_n")))
    found = reduce(DataFrame.unionByName, parts)
    wide = [F.coalesce(F.max(F.when(F.col("_i") == i, F.col("_n"))), F.lit(0)).alias(c + "_distinct") for i, c in enumerate(cols)]
    return found.groupBy(*keys).agg(*wide)


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per value in value order."""
    return df.dropna(subset=[key]).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)


def bounds(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def _long(wide: DataFrame, value: str) -> DataFrame:
    return wide.unpivot([], wide.columns, "column", value)


def null_counts(df: DataFrame, top: int | None = 20) -> DataFrame:
    """(column, nulls), most nulls first; ``top`` limits the report, not the scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    ranked = _long(wide, "nulls").orderBy(F.desc("nulls"), "column")
    return ranked.limit(top) if top is not None else ranked


def sentinel_counts(
    df: DataFrame, cols: Sequence[str], limit: float = D.SENTINEL_LIMIT
) -> DataFrame:
    """(column, invalid): values at or below the sentinel limit, one pass."""
    wide = df.agg(*[F.count_if(F.col(c) <= F.lit(limit)).alias(c) for c in cols])
    return _long(wide, "invalid")


def totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in cols])


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) of the table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def top_k(df: DataFrame, col: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows highest in ``col``; ``ties`` make equal values deterministic."""
    return df.orderBy(F.desc(col), *ties).limit(k)
