"""Projections: renames, checks and column arithmetic (no shuffle in any of them)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.functions.text import clean_column_name


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def require_columns(df: DataFrame, names: Sequence[str], table: str = "table") -> DataFrame:
    """The frame itself, or ``ValueError`` naming every missing column."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks required columns: {missing}")
    return df


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that the frame has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def ensure_columns(df: DataFrame, names: Sequence[str], value=0) -> DataFrame:
    """Add each absent column with a constant value."""
    absent = {n: F.lit(value) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_column_name(n) for n in df.columns])


def _pairs(df: DataFrame, pairs: Mapping[str, tuple[str, str]], combine) -> DataFrame:
    have = set(df.columns)
    out = {
        name: combine(F.col(a), F.col(b))
        for name, (a, b) in pairs.items()
        if a in have and b in have
    }
    return df.withColumns(out) if out else df


def difference(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``out = a - b`` for each pair whose two columns exist."""
    return _pairs(df, pairs, lambda a, b: a - b)


def product(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``out = a * b`` for each pair whose two columns exist."""
    return _pairs(df, pairs, lambda a, b: a * b)


def total(cols: Sequence[Column]) -> Column:
    return reduce(add, cols)


def weighted_sum(
    df: DataFrame, terms: Mapping[str, tuple[float, float]], out: str
) -> DataFrame:
    """``out = sum(weight * (col / divisor))`` with missing values as 0."""
    parts = [
        F.lit(float(w)) * (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) / F.lit(float(d)))
        for c, (w, d) in terms.items()
    ]
    return df.withColumn(out, total(parts))


def row_sum(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, total([F.col(c) for c in cols]))


def any_positive(df: DataFrame, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """``out = 1`` where the listed counts add up to more than zero."""
    return df.withColumns({
        out: (total([F.col(c) for c in cols]) > 0).cast("int") for out, cols in flags.items()
    })
