"""Keeping joins and ordered work spread out when one key holds much of the data.

* ``lookup_join``: broadcast only a side whose bytes were measured, otherwise a shuffle join with
  the hot keys salted.
* ``sliced``: the rows of hot keys, cut into contiguous slices by range partitioning, so that a
  running computation becomes "inside the slice" plus "carried over from earlier slices".
* ``ranged``: the same for the order of a whole frame.
* ``kth_key``: an order statistic by counts, column by column, without moving rows.

Slices come from Spark's sampled range partitioning over key, order and a tie column, so they hold
about as many rows as asked for however often an order value repeats, and nothing is collected.
Sliced rows are written once: a slice number must not change between two reads.  There can be many
more slices than tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stormgrid.session import materialize

LOOKUP_BYTES = 64 * 1024 * 1024
SLICE_ROWS = 4_000_000


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------
def _bytes(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
    return F.lit(8)


def table_bytes(df: DataFrame) -> int:
    """About the bytes of all rows in memory, by one aggregation."""
    row = reduce(lambda a, b: a + b, [_bytes(f.name, f.dataType) for f in df.schema], F.lit(16))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


_READS = {"Project", "Filter", "Relation", "LogicalRDD", "LocalRelation", "Range"}


def _stored(df: DataFrame) -> bool:
    """Whether a frame only reads, filters and projects what is stored."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return set(re.findall(r"^[\s:+-]*([A-Za-z]+)", plan, re.M)) <= _READS


def row_hash(df: DataFrame, *more: Column) -> Column:
    """A hash of the row; maps cannot be hashed and are left out."""
    cols = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*cols, *more)


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_bytes: int = LOOKUP_BYTES,
    hot_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Join ``df`` with a lookup table; ``how`` is inner, left, left_semi or left_anti.

    The bytes of the lookup side are measured first.  Up to ``max_bytes`` it is broadcast and
    ``df`` is not shuffled; beyond that both sides shuffle, salted for hot keys.  A lookup side that
    is the result of joins or aggregations is written once, so measuring it does not compute it twice.
    """
    keys = list(keys)
    if not _stored(dim):
        dim = materialize(dim)
    if table_bytes(dim) <= max_bytes:
        return df.join(F.broadcast(dim), keys, how)
    return salted_join(df, dim, keys, how, hot_rows)


def salted_join(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str, hot_rows: int = SLICE_ROWS
) -> DataFrame:
    """Shuffle join that spreads each key with more than ``hot_rows`` rows in ``df``.

    A hot key gets ``ceil(rows / hot_rows)`` salts.  Its rows in ``df`` are dealt out by a hash of
    the whole row and its input partition (the same when a task is retried), its rows in ``dim``
    are repeated once per salt.  Rows with a null key match nothing and are spread by their hash.
    There is at most one hot key for every ``hot_rows`` rows.
    """
    keys = list(keys)
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    hot = materialize(
        df.filter(~unknown).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = row_hash(df, F.spark_partition_id())
    left = (
        df.withColumn("_hash", spread).join(hot, keys, "left")
        .withColumn("_salt", F.when(unknown, F.pmod("_hash", F.lit(1 << 20)))
                    .otherwise(F.pmod("_hash", salts)).cast("int"))
        .drop("_salts", "_hash")
    )
    right = (
        dim.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


# ---------------------------------------------------------------------------
# Ordered slices
# ---------------------------------------------------------------------------
def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys up to ``slice_rows`` rows, and those of hotter keys, or None.

    Rows of hot keys have ``_key`` (the key as one value, in which nulls are equal), ``_slice``,
    rising with ``(order, _tie)`` inside a key, and ``_tie``, a hash of the row that sets the order
    of rows with equal order values.
    """
    keys, order = list(keys), list(order)
    keyed = df.withColumn("_key", F.struct(*keys))
    hot = materialize(
        keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
    )
    rows = hot.agg(F.sum("_n")).first()[0]
    if not rows:
        return df, None
    hot = hot.select("_key")
    tied = keyed.join(hot, "_key", "left_semi").withColumn("_tie", row_hash(df))
    cut = _cut(tied, [*keys, *order, "_tie"], math.ceil(rows / slice_rows), rows)
    return keyed.join(hot, "_key", "left_anti").drop("_key"), cut


def ranged(df: DataFrame, order: Sequence[str | Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``_slice``, rising with ``order``, of about ``slice_rows`` rows each.

    Rows that ``order`` does not tell apart may be in two slices that follow each other.
    """
    rows = df.count()
    parts = math.ceil(rows / slice_rows)
    if parts <= 1:
        return df.withColumn("_slice", F.lit(0))
    return _cut(df, order, parts, rows)


def _cut(df: DataFrame, by: Sequence[str | Column], parts: int, rows: int) -> DataFrame:
    """``df`` with ``_slice``: ``parts`` or a few more slices, rising with ``by``; written once.

    A task is not a slice: with small slices there are no more tasks than the session shuffles to, so
    the sample of the range partitioning and the figures of the tasks, which go to the driver, do not
    grow with the rows.  A task sorts its range and cuts it by position into slices of even size.
    """
    tasks = min(parts, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / SLICE_ROWS)))
    dealt = df.repartitionByRange(tasks, *by)
    if tasks == parts:
        return materialize(dealt.withColumn("_slice", F.spark_partition_id()))
    # The id is the number of the partition, then 33 bits of the position in it.
    placed = materialize(dealt.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    each = math.ceil(parts / tasks)
    number = F.col("_part") * each + F.floor(at * each / F.col("_rows"))
    return (
        placed.withColumn("_part", part).join(F.broadcast(sizes), "_part")
        .withColumn("_slice", number.cast("int")).drop("_id", "_part", "_rows")
    )


# ---------------------------------------------------------------------------
# Order statistics
# ---------------------------------------------------------------------------
def _rising(df: DataFrame, name: str) -> DataFrame:
    """Rows per value of a column; single rows are merged before they are shuffled."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))


#: Numbers a quantile sketch keeps, and the share of rows its answers may be off by.
_SKETCH = 10_000
_OFF = 2 / _SKETCH


def _around(df: DataFrame, name: str, k: int, slice_rows: int) -> tuple[DataFrame, int]:
    """The rows whose value is near the ``k``-th one's, and how many rows lie below them.

    While a column has more than ``slice_rows`` distinct values, a quantile sketch names two values
    the ``k``-th lies between and the rows are narrowed to those; sketches and counts are partial
    aggregates, so no row moves.  Text has no quantiles and stays whole.
    """
    c, below = F.col(name), 0
    kind = df.schema[name].dataType
    while isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        seen = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(c).alias("values")).first()
        if seen["values"] <= slice_rows:
            break
        share = (k - below) / seen["rows"]
        at = [max(0.0, share - _OFF), min(1.0, share + _OFF)]
        low, high = df.agg(F.percentile_approx(c, at, _SKETCH).alias("q")).first()["q"]
        inside = c.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        counts = df.agg(F.count_if(c < F.lit(low).cast(kind)).alias("below"), F.count_if(inside).alias("inside")).first()
        if not counts["below"] < k - below <= counts["below"] + counts["inside"] or counts["inside"] == seen["rows"]:
            break
        df, below = df.filter(inside), below + counts["below"]
    return df, below


def _kth_value(df: DataFrame, name: str, k: int, rows: int, slice_rows: int) -> Row | None:
    """(value, below, own): the ``k``-th of a column, nulls last, rows before it and rows equal to it."""
    below = 0
    if rows > slice_rows:
        known = df.filter(F.col(name).isNotNull())
        valued = known.count()
        if k > valued:
            return Row(value=None, below=valued, own=rows - valued) if k <= rows else None
        df, below = _around(known, name, k, slice_rows)
    by = F.col(name).asc_nulls_last()
    keys = ranged(_rising(df, name), [by], slice_rows) if rows > slice_rows else _rising(df, name).withColumn("_slice", F.lit(0))
    chosen = 0
    if rows > slice_rows:
        for row in keys.groupBy("_slice").agg(F.sum("_n").alias("n")).orderBy("_slice").toLocalIterator():
            if below + row["n"] >= k:
                chosen = row["_slice"]
                break
            below += row["n"]
    upto = Window.partitionBy("_slice").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    seen = keys.filter(F.col("_slice") == chosen).withColumn("_seen", F.sum("_n").over(upto))
    found = seen.filter(F.col("_seen") >= k - below).orderBy("_seen").select(name, "_n", "_seen").first()
    return found and Row(value=found[name], below=below + found["_seen"] - found["_n"], own=found["_n"])


def kth_key(
    df: DataFrame, order: Sequence[str], k: int, slice_rows: int = SLICE_ROWS, rows: int | None = None
) -> Row | None:
    """Ordering key of the ``k``-th row (1-based) under ``order``, nulls last; None past the end.

    One column after the other: rows are counted by value, the value the ``k``-th row has is found
    by adding up counts, and only rows with that value are looked at for the next column.  ``rows``
    is the number of rows, where it is known.
    """
    rows = df.count() if rows is None else rows
    if not 1 <= k <= rows:
        return None
    found = {}
    for name in order:
        at = _kth_value(df.select(*order), name, k, rows, slice_rows)
        if at is None:
            return None
        found[name] = at["value"]
        kind = df.schema[name].dataType
        same = F.col(name).isNull() if at["value"] is None else F.col(name) == F.lit(str(at["value"])).cast(kind)
        df, k, rows = df.filter(same), k - at["below"], at["own"]
    return Row(**found)


def up_to(order: Sequence[str], at: Row, kinds: T.StructType) -> Column:
    """``(o1, o2, ...) <= at``, nulls last, in a form whose first comparison reaches the scan.

    It is true or not true: a row with a null on which it turns gives null, as a filter takes it.
    """
    order = list(order)
    within = F.lit(True)
    for c in reversed(order):
        if at[c] is None:
            within = F.col(c).isNotNull() | within
        else:
            value = F.lit(str(at[c])).cast(kinds[c].dataType)
            within = (F.col(c) < value) | ((F.col(c) == value) & within)
    if at[order[0]] is not None:
        within = (F.col(order[0]) <= F.lit(str(at[order[0]])).cast(kinds[order[0]].dataType)) & within
    return within
