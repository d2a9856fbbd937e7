"""Time-series operators: fill, lag, rolling sums, chronological split.

The window functions partition by key.  On a panel a key has one row per day, so
its group is bounded by the calendar and ``slice_rows=None`` skips the check.  On
event-grain tables the default counts rows per key first; a key with more than
``slice_rows`` rows is cut into time slices, and what a slice needs from earlier
ones is carried over through a table of slice summaries.  Rows of equal order
value keep one order inside a hot key, that of a hash of the row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from stormgrid import defaults as D
from stormgrid.operators.scale import (
    SLICE_ROWS, kth_key, sliced, up_to,
)

_START, _END = Window.unboundedPreceding, Window.unboundedFollowing


def _names(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def fill(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    cols: Sequence[str],
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """Forward fill inside each key, then backward fill of what leads the group.

    After the forward fill only leading gaps are open, and all of them take the
    first value of the group; no look-ahead window is needed.  A group without
    any value stays null.
    """
    keys, order, cols = _names(keys), _names(order), list(cols)
    cold, hot = sliced(df, keys, order, slice_rows) if slice_rows else (df, None)
    w = Window.partitionBy(*keys).orderBy(*order)
    filled = cold.withColumns({
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(w.rowsBetween(_START, 0)),
            F.first(c, ignorenulls=True).over(w.rowsBetween(_START, _END)),
        )
        for c in cols
    })
    if hot is None:
        return filled
    at = F.struct(*order, "_tie")
    ends = hot.groupBy("_key", "_slice").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in cols],
    )
    by_slice = Window.partitionBy("_key").orderBy("_slice")
    carried = ends.select(
        "_key", "_slice",
        *[F.last(f"_last_{c}", True).over(by_slice.rowsBetween(_START, -1)).alias(f"_prev_{c}")
          for c in cols],
        *[F.first(f"_first_{c}", True).over(by_slice.rowsBetween(_START, _END))
          .alias(f"_head_{c}") for c in cols],
    )
    w = Window.partitionBy("_key", "_slice").orderBy(*order, "_tie")
    carved = hot.join(carried, ["_key", "_slice"]).withColumns({
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(w.rowsBetween(_START, 0)),
            F.col(f"_prev_{c}"),
            F.col(f"_head_{c}"),
        )
        for c in cols
    })
    return filled.unionByName(carved.select(*df.columns))


def _predecessors(hot: DataFrame, order: list[str], rows: int) -> DataFrame:
    """Copies of the last ``rows`` rows before each slice, numbered as rows of that slice.

    A slice can be shorter than ``rows``, so the rows may come from several slices.
    """
    latest = Window.partitionBy("_key", "_slice").orderBy(
        *[F.desc(c) for c in order], F.desc("_tie")
    )
    tails = (
        hot.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= rows)
        .drop("_back")
        .withColumn("_pos", F.row_number().over(Window.partitionBy("_key").orderBy("_slice", *order, "_tie")))
    )
    by_slice = Window.partitionBy("_key").orderBy("_slice")
    needs = (
        tails.groupBy("_key", "_slice").agg(F.max("_pos").alias("_end"))
        .withColumn("_end", F.lag("_end").over(by_slice))
        .filter(F.col("_end").isNotNull())
        .select(
            "_key", "_slice",
            F.explode(F.sequence(F.greatest(F.lit(1), F.col("_end") - (rows - 1)), "_end"))
            .alias("_pos"),
        )
    )
    return tails.drop("_slice").join(needs, ["_key", "_pos"]).drop("_pos")


def history(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    lags: Mapping[str, Sequence[int]] | None = None,
    sums: Mapping[str, Sequence[int]] | None = None,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """Lags and rolling sums of earlier rows, all in one window pass.

    Adds ``<col>_<n>d``: the value ``n`` rows back, or the sum of the ``n`` rows
    before the current one (fewer at the start, null with none).  Windows count
    rows, not days.
    """
    keys, order = _names(key), _names(order)
    lags, sums = lags or {}, sums or {}
    deepest = max([n for ns in [*lags.values(), *sums.values()] for n in ns], default=0)
    if not deepest:
        return df

    def added(w: WindowSpec) -> dict[str, Column]:
        out = {f"{c}_{n}d": F.lag(c, n).over(w) for c, ns in lags.items() for n in ns}
        return out | {
            f"{c}_{n}d": F.sum(c).over(w.rowsBetween(-n, -1)) for c, ns in sums.items() for n in ns
        }

    cold, hot = sliced(df, keys, order, slice_rows) if slice_rows else (df, None)
    out = cold.withColumns(added(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return out.select(*df.columns, *added(Window.partitionBy(*keys).orderBy(*order)))
    both = hot.withColumn("_copy", F.lit(False)).unionByName(
        _predecessors(hot, order, deepest).withColumn("_copy", F.lit(True))
    )
    # Copies come first, also where a row of the slice is equal to one of them.
    w = Window.partitionBy("_key", "_slice").orderBy(F.desc("_copy"), *order, "_tie")
    carved = both.withColumns(added(w)).filter(~F.col("_copy"))
    return out.unionByName(carved.select(*out.columns))


def lag(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    cols: Sequence[str],
    n: int = 1,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    return history(df, key, order, lags={c: [n] for c in cols}, slice_rows=slice_rows)


def rolling_sum(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    windows: Mapping[str, Sequence[int]],
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    return history(df, key, order, sums=windows, slice_rows=slice_rows)


def in_first_part(
    df: DataFrame,
    order: str,
    tie: Sequence[str],
    fraction: float = D.TRAIN_FRACTION,
    slice_rows: int = SLICE_ROWS,
) -> Column:
    """Predicate for the first ``int(n * fraction)`` rows by ``(order, *tie)``, nulls last.

    The boundary row is found by counting; the predicate is then a plain
    comparison with literals, so neither part of the split sorts or shuffles.
    ``order`` and ``tie`` together must identify a row.
    """
    by, rows = [order, *tie], df.count()
    at = kth_key(df, by, int(rows * fraction), slice_rows, rows)
    return F.lit(False) if at is None else up_to(by, at, df.schema)


def time_split(
    df: DataFrame,
    order: str,
    tie: Sequence[str],
    fraction: float = D.TRAIN_FRACTION,
    slice_rows: int = SLICE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(earlier part, later part) of the frame; rows without an order value come last."""
    early = in_first_part(df, order, tie, fraction, slice_rows)
    return df.filter(early), df.filter(~F.coalesce(early, F.lit(False)))
