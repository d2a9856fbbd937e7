"""Time series against pandas, and sliced hot keys against plain windows."""

import datetime
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stormgrid import operators as op
from stormgrid.operators.scale import kth_key, ranged, sliced, up_to
from tests.conftest import plan, rows

DAY0 = datetime.date(2021, 1, 1)


def panel(seed=0, groups=4, days=60, nulls=0.3):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        for d in range(days):
            if rng.random() < 0.1:
                continue  # a missing day: windows count rows
            x = None if rng.random() < nulls else float(rng.randint(0, 20))
            out.append((f"g{g}", DAY0 + datetime.timedelta(d), x, rng.randint(0, 5)))
    rng.shuffle(out)
    return out


SCHEMA = "k string, d date, x double, n int"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(panel(), SCHEMA).repartition(5)


def as_pandas(data):
    return pd.DataFrame(data, columns=["k", "d", "x", "n"]).sort_values(["k", "d"]).reset_index(drop=True)


def same(left, right):
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert (a is None and (b is None or np.isnan(b))) or a == pytest.approx(b)


@pytest.mark.parametrize("slice_rows", [None, 1000, 7, 15])
def test_history_equals_pandas(spark, frame, slice_rows):
    got = op.history(
        frame, "k", "d", lags={"x": [1]}, sums={"x": [3, 7, 30], "n": [3]}, slice_rows=slice_rows
    ).orderBy("k", "d").collect()
    want = as_pandas(panel())
    by = want.groupby("k")
    same([r["x_1d"] for r in got], by["x"].shift(1))
    for w in (3, 7, 30):
        rolled = by["x"].transform(lambda s: s.shift(1).rolling(w, min_periods=1).sum())
        same([r[f"x_{w}d"] for r in got], rolled)
    same([r["n_3d"] for r in got], by["n"].transform(lambda s: s.shift(1).rolling(3, min_periods=1).sum()))


def test_lag_and_rolling_wrappers(spark, frame):
    both = op.rolling_sum(op.lag(frame, "k", "d", ["n"], 2), "k", "d", {"n": [2]})
    assert both.columns == ["k", "d", "x", "n", "n_2d", "n_2d"]


@pytest.mark.parametrize("slice_rows", [None, 1000, 7, 15])
def test_fill_equals_pandas(spark, frame, slice_rows):
    got = [r["x"] for r in op.fill(frame, "k", "d", ["x"], slice_rows).orderBy("k", "d").collect()]
    want = as_pandas(panel())
    by = want.groupby("k")["x"]
    same(got, by.ffill().fillna(by.bfill()))


def test_fill_keeps_empty_groups_null_and_values(spark):
    data = [("a", DAY0, None, 0), ("a", DAY0 + datetime.timedelta(1), None, 0), ("b", DAY0, 1.0, 0)]
    df = spark.createDataFrame(data, SCHEMA)
    for size in (None, 1):
        assert [r[2] for r in rows(op.fill(df, "k", "d", ["x"], size))] == [None, None, 1.0]


def test_fill_hot_key_with_late_first_value(spark):
    """A hot key whose only values sit in one late slice."""
    data = [("h", DAY0 + datetime.timedelta(i), 5.0 if i == 90 else None, 0) for i in range(120)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert {r["x"] for r in op.fill(df, "k", "d", ["x"], slice_rows=10).collect()} == {5.0}


def test_slices_are_contiguous_and_many(spark, frame):
    cold, hot = sliced(frame, ["k"], ["d"], 10)
    assert cold.count() == 0 and hot.count() == frame.count()
    per_key = {}
    for r in hot.orderBy("k", "d").collect():
        per_key.setdefault(r["k"], []).append(r["_slice"])
    for ids in per_key.values():
        assert ids == sorted(ids)
        assert len(set(ids)) >= 4
    assert sliced(frame, ["k"], ["d"], 1000)[1] is None


@pytest.mark.parametrize("key", ["a", None])
def test_few_order_values_and_null_keys_are_cut(spark, key):
    """One key, null or not, of 20,000 rows on 30 days."""
    df = spark.range(20_000).select(
        F.lit(key).cast("string").alias("k"), F.date_add(F.lit(DAY0), (F.col("id") % 30).cast("int")).alias("d"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("x"), F.col("id").cast("int").alias("n"),
    )
    cold, hot = sliced(df.unionAll(spark.createDataFrame([("z", DAY0, 1.0, 1)], SCHEMA)), ["k"], ["d"], 1000)
    sizes = [r["count"] for r in hot.groupBy("_slice").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2000 and cold.count() == 1
    filled = op.fill(df, "k", "d", ["x"], 1000)
    assert filled.count() == 20_000 and filled.filter("x is null").count() == 0
    assert filled.filter("n % 3 = 0 and x <> n").count() == 0
    counts = op.history(df.withColumn("one", F.lit(1)), "k", "d", sums={"one": [25]}, slice_rows=1000)
    assert counts.agg(F.sum("one_25d")).first()[0] == 25 * (20_000 - 25) + sum(range(25))


def test_many_slices_take_few_tasks(spark):
    """4,000 slices of one key, cut in as many tasks as the session shuffles to, evenly and in order."""
    df = spark.range(20_000).select(F.lit("h").alias("k"), F.col("id").alias("d"), F.pmod(F.col("id"), F.lit(97)).alias("x"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = ranged(df, ["d"], 5)
    for parts in (sliced(df, ["k"], ["d"], 5)[1], cut):
        assert parts.rdd.getNumPartitions() <= tasks
        ends = parts.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("a"), F.max("d").alias("b"))
        found = rows(ends.select("a", "b", "n", "_slice"), "_slice")
        assert len(found) == 4000 and max(n for _, _, n, _ in found) <= 10
        assert [d for a, b, _, _ in found for d in (a, b)] == sorted(d for a, b, _, _ in found for d in (a, b))


@pytest.mark.parametrize("slice_rows", [1, 3, 7])
def test_copies_of_rows_over_several_slices(spark, slice_rows):
    """Rows that come up to 20 times on one day: each has as many rows before it as its place says."""
    data = [("h", DAY0 + datetime.timedelta(i // 20), None if i // 20 % 2 else float(i // 20), 1) for i in range(200)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    counts = op.history(df, "k", "d", lags={"x": [1], "n": [3]}, sums={"n": [4, 30]}, slice_rows=slice_rows)
    plain = op.history(df, "k", "d", lags={"x": [1], "n": [3]}, sums={"n": [4, 30]}, slice_rows=None)
    assert rows(counts) == rows(plain)
    assert rows(op.fill(df, "k", "d", ["x"], slice_rows)) == rows(op.fill(df, "k", "d", ["x"], None))


def test_history_needs_one_shuffle_and_one_sort(spark, frame):
    text = plan(op.history(
        frame, "k", "d", lags={"x": [1], "n": [1]}, sums={"x": [3, 7, 14, 30], "n": [3, 7]},
        slice_rows=None,
    ))
    assert text.count("Exchange hashpartitioning(k") == 1
    assert text.count("+- Sort ") == 1 and text.count("Window [") == 1


@pytest.mark.parametrize("slice_rows", [4_000_000, 60, 17])
@pytest.mark.parametrize("k", [1, 2, 77, 500, 999, 1000])
def test_kth_key(spark, slice_rows, k):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3]), i) for i in range(1000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(3)
    assert tuple(kth_key(df, ["a", "b"], k, slice_rows)) == sorted(data)[k - 1]


def test_kth_key_with_copies_and_past_the_end(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 3, "a int")
    assert kth_key(df, ["a"], 50, 1)["a"] == 1
    assert kth_key(df, ["a"], 51, 1)["a"] == 2
    assert kth_key(df, ["a"], 54) is None
    assert kth_key(df, ["a"], 0) is None


@pytest.mark.parametrize("slice_rows", [4_000_000, 9])
def test_time_split(spark, slice_rows):
    data = [(DAY0 + datetime.timedelta(i // 16), f"r{i % 16:02d}") for i in range(16 * 7)]
    df = spark.createDataFrame(data, "fecha date, alcaldia string").repartition(3)
    train, test = op.time_split(df, "fecha", ["alcaldia"], 0.8, slice_rows)
    assert train.count() == int(112 * 0.8) and train.count() + test.count() == 112
    assert rows(train, "fecha", "alcaldia") == sorted(data)[:89]
    assert train.agg(F.max("fecha")).first()[0] <= test.agg(F.min("fecha")).first()[0]


def test_split_predicate_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(DAY0, "a"), (DAY0, "b")], "fecha date, alcaldia string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    table = spark.read.parquet(path)
    early = up_to(["fecha", "alcaldia"], df.first(), table.schema)
    assert "LessThanOrEqual(fecha" in plan(table.filter(early))


@pytest.mark.parametrize("slice_rows", [4_000_000, 3])
@pytest.mark.parametrize("fraction", [0.3, 0.8, 0.9, 1.0])
def test_split_keeps_rows_without_a_day(spark, slice_rows, fraction):
    data = [(DAY0 + datetime.timedelta(i), f"r{i}") for i in range(7)] + [(DAY0, None), (None, "a"), (None, "b"), (None, None)]
    df = spark.createDataFrame(data, "fecha date, alcaldia string").repartition(3)
    train, test = op.time_split(df, "fecha", ["alcaldia"], fraction, slice_rows)
    late = datetime.date(9999, 1, 1)
    ordered = sorted(data, key=lambda r: (r[0] or late, r[1] or "~"))
    cut = int(11 * fraction)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted((tuple(r) for r in train.collect()), key=key) == sorted(ordered[:cut], key=key)
    assert sorted((tuple(r) for r in test.collect()), key=key) == sorted(ordered[cut:], key=key)


def test_split_of_nothing(spark):
    df = spark.createDataFrame([(DAY0, "a")], "fecha date, alcaldia string")
    train, test = op.time_split(df, "fecha", ["alcaldia"])
    assert train.count() == 0 and test.count() == 1
