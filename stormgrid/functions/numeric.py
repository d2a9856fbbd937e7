"""Small scalar rules: flags, logs, bins and calendar parts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_least(c: Column, k) -> Column:
    """1 where ``c >= k``; missing counts as 0."""
    return F.coalesce((c >= F.lit(k)).cast("int"), F.lit(0))


def in_months(c: Column, months: Iterable[int]) -> Column:
    """1 where the date falls in one of ``months``; missing counts as 0."""
    return F.coalesce(F.month(c).isin(list(months)).cast("int"), F.lit(0))


def calendar(df: DataFrame, date_col: str) -> DataFrame:
    """Add month, quarter and weekday (Monday is 0)."""
    d = F.col(date_col)
    return df.withColumns(
        {"mes": F.month(d), "trimestre": F.quarter(d), "dia_semana": F.weekday(d)}
    )


def log1p0(df: DataFrame, cols: Sequence[str], suffix: str = "_log") -> DataFrame:
    """Add ``ln(1 + c)`` for each column, missing counting as 0."""
    return df.withColumns({c + suffix: F.log1p(F.coalesce(F.col(c), F.lit(0))) for c in cols})


def right_bins(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins with the lowest edge included; outside and null give null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    out = F.when(c < F.lit(edges[0]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(edge), F.lit(label))
    return out
