"""Column, cleaning, join and aggregate operators on small literal frames."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid import operators as op
from stormgrid.operators.scale import lookup_join, salted_join, table_bytes
from tests.conftest import plan, rows


def test_rename_ignores_unknown(spark):
    assert op.rename(spark.range(1), {"id": "k", "x": "y"}).columns == ["k"]


def test_require_columns_names_all_missing(spark):
    df = spark.range(1)
    assert op.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match=r"calls lacks required columns: \['a', 'b'\]"):
        op.require_columns(df, ["a", "id", "b"], "calls")


def test_ensure_present_clean(spark):
    df = op.ensure_columns(spark.range(1), ["id", "n"])
    assert rows(df) == [(0, 0)]
    assert op.present(df, ["n", "z", "id"]) == ["n", "id"]
    assert op.clean_names(df.toDF(" A B", "C/d ")).columns == ["a_b", "c_d"]


def test_arithmetic_skips_absent_columns(spark):
    df = spark.createDataFrame([(5.0, 2.0), (None, 1.0)], "a double, b double")
    assert op.difference(df, {"d": ("a", "b"), "e": ("a", "z")}).columns == ["a", "b", "d"]
    assert [r["p"] for r in op.product(df, {"p": ("a", "b")}).collect()] == [10.0, None]
    got = op.weighted_sum(df, {"a": (0.5, 1), "b": (0.3, 3)}, "w")
    assert [r["w"] for r in got.collect()] == [2.5 + 0.3 * (2.0 / 3.0), 0.3 * (1.0 / 3.0)]


def test_row_sum_and_flags(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "a int, b int")
    got = op.any_positive(op.row_sum(df, ["a", "b"], "t"), {"f": ["a", "b"], "g": ["b"]})
    assert rows(got) == [(0, 0, 0, 0, 0), (1, 0, 1, 1, 0)]


def test_filters(spark):
    df = spark.createDataFrame(
        [(19.0, -99.4, "a"), (19.6, -98.9, ""), (19.7, -99.0, "b"), (None, -99.0, "c")],
        "lat double, lon double, s string",
    )
    assert op.keep_bbox(df, "lat", "lon").count() == 2
    assert op.keep_nonempty(op.drop_null(df, ["lat"]), "s").count() == 2
    assert op.keep_values(df, "s", ["a", "b"]).count() == 2


def test_mask_sentinel_limit(spark):
    df = spark.createDataFrame([(-999.0,), (-99.0,), (-98.9,), (None,), (1.0,)], "x double")
    assert [r[0] for r in op.mask_sentinel(df, ["x"]).collect()] == [None, None, -98.9, None, 1.0]
    assert rows(op.sentinel_counts(df, ["x"])) == [("x", 2)]


def test_zero_fill_and_numbers(spark):
    df = spark.createDataFrame([("1.0",), ("x",)], "x string")
    assert rows(op.zero_fill_int(op.numbers(df, ["x"]), ["x"])) == [(0,), (1,)]


def test_distinct_by(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert rows(op.distinct_by(df, ["k"], "o")) == [(1, 2, "b"), (2, 9, "z")]
    assert op.distinct_by(df, ["k"]).count() == 2
    # the partial aggregate runs before the shuffle
    assert plan(op.distinct_by(df, ["k"], "o")).count("Aggregate") >= 2


def test_crosstab_drops_nulls_and_counts_unseen(spark):
    data = [("a", "x"), ("a", "x"), ("a", None), (None, "x"), ("b", "y"), ("b", "w")]
    df = spark.createDataFrame(data, "k string, c string")
    got = rows(op.crosstab(df, ["k"], "c", ["x", "y", "z"]))
    assert got == [("a", 2, 0, 0), ("b", 0, 1, 0)]
    want = pd.crosstab(
        pd.Series([d[0] for d in data], name="k"), pd.Series([d[1] for d in data], name="c")
    )
    found = op.crosstab(df, ["k"], "c").toPandas().set_index("k").sort_index()
    assert found[want.columns].to_dict() == want.to_dict()


def test_crosstab_is_one_shuffle(spark):
    df = spark.createDataFrame([("a", "x")], "k string, c string")
    assert plan(op.crosstab(df, ["k"], "c", ["x", "y"])).count("Exchange") == 1


def test_mean_by_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 9.0)], "k string, x double")
    assert rows(op.mean_by(df, ["k"], ["x"])) == [("a", 2.0)]


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in op.value_counts(df, "k").collect()] == [("b", 2), ("a", 1)]
    assert [tuple(r) for r in op.value_share(df, "k", 2).collect()] == [("b", 2, 66.67), ("a", 1, 33.33)]
    assert [tuple(r) for r in op.count_by(df, "k").collect()] == [("a", 1), ("b", 2)]
    assert [r[0] for r in op.distinct_sorted(df, "k").collect()] == ["a", "b"]


def test_rates_distincts_bounds_profile(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 0, 2), ("b", 1, 2)], "k string, f int, n int")
    assert [tuple(r) for r in op.rate_by(df, "k", "f").collect()] == [("b", 100.0), ("a", 50.0)]
    assert rows(op.count_distinct_by(df, ["f", "n"], ["k"])) == [("a", 2, 1), ("b", 1, 1)]
    assert rows(op.count_distinct_by(df, ["k"])) == [(2,)]
    assert rows(op.bounds(df, "f")) == [(0, 1)]
    assert [tuple(r) for r in op.null_counts(df, top=2).collect()] == [("n", 1), ("f", 0)]
    assert rows(op.totals(df, ["f"])) == [(2,)]
    assert rows(op.shape(df)) == [(3, 3)]
    assert [r["k"] for r in op.top_k(df, "f", 2, ["k"]).collect()] == ["a", "b"]


def _skewed(spark):
    rng = random.Random(3)
    big = [(rng.choice([1, 1, 1, 2, 3, 4, 5]), i) for i in range(700)] + [(None, -1)]
    df = spark.createDataFrame(big, "k int, i int").repartition(7)
    dim = spark.createDataFrame([(k, f"n{k}") for k in (1, 2, 3, 9)], "k int, name string")
    return df, dim


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    df, dim = _skewed(spark)
    want = rows(df.join(dim, ["k"], how))
    assert rows(salted_join(df, dim, ["k"], how, hot_rows=20)) == want
    assert rows(lookup_join(df, dim, ["k"], how, max_bytes=2, hot_rows=20)) == want
    assert rows(lookup_join(df, dim, ["k"], how)) == want


def test_salts_spread_a_hot_key_of_one_partition_and_null_keys(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, 1).alias("k"), "id").coalesce(1)
    dim = spark.createDataFrame([(1, "a")], "k int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(df, dim, ["k"], "left", hot_rows=250)
        spread = joined.groupBy(F.col("k").isNull(), F.spark_partition_id()).count().collect()
        assert joined.count() == 10_000 and joined.filter("name = 'a'").count() == 5000
        assert len(spread) == 8 and max(r["count"] for r in spread) < 2500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookup_join_measures_bytes(spark):
    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("t"), F.array("id").alias("a"))
    assert 1_000_000 < table_bytes(wide) < 1_020_000 and table_bytes(wide.limit(0)) == 0


def test_salted_join_with_repeated_lookup_keys(spark):
    df, dim = _skewed(spark)
    twice = dim.unionAll(dim.withColumn("name", F.lit("again")))
    want = rows(df.join(twice, ["k"], "inner"))
    assert rows(salted_join(df, twice, ["k"], "inner", hot_rows=20)) == want


def test_lookup_join_broadcasts_only_small_sides(spark):
    df, dim = _skewed(spark)
    assert "BroadcastHashJoin" in plan(lookup_join(df, dim, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(lookup_join(df, dim, ["k"], max_bytes=1))
        assert "SortMergeJoin" in big
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_known_and_attach(spark):
    df, dim = _skewed(spark)
    assert op.keep_known(df, dim, ["k"]).columns == ["k", "i"]
    assert op.keep_known(df, dim.unionAll(dim), ["k"]).count() == op.attach(df, dim, ["k"]).count()


def test_left_zero(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 1.5)], "k int, x double")
    b = spark.createDataFrame([(1, 4)], "k int, n int")
    assert rows(op.left_zero(a, b, ["k"], ["n", "m"])) == [(1, 0.5, 4, 0), (2, 1.5, 0, 0)]


def test_style_defaults(spark):
    regions = spark.createDataFrame([("A",), ("B",), ("C",)], "alcaldia string")
    day = spark.createDataFrame([("A", "ALTO"), ("B", "RARO")], "alcaldia string, riesgo string")
    got = {r["alcaldia"]: (r["fill_color"], r["fill_opacity"]) for r in op.style(regions, day, "alcaldia").collect()}
    assert got == {
        "A": (D.PALETTE["ALTO"], 0.75), "B": (D.UNKNOWN_RISK_COLOR, 0.75), "C": (D.NO_DATA_COLOR, 0.30),
    }


def test_fact_last_row_wins(spark):
    d = datetime.date(2021, 5, 1)
    df = spark.createDataFrame(
        [(d, "Á", "0.9", "1.0", 1, "alto", 2), (d, "a ", "0.1", "0", 0, "bajo", 1), (d, "b", "x", "0", 0, None, 1)],
        "fecha date, alcaldia string, probabilidad_lluvia_intensa string, "
        "prediccion_lluvia_intensa string, valor_real int, riesgo string, orden int",
    )
    fact = op.fact_risk(df, "orden")
    assert rows(fact) == [
        (d, 2021, 5, 1, "A", 0.9, 1, 1, "ALTO"), (d, 2021, 5, 1, "B", None, 0, 0, None),
    ]
    assert rows(op.dim_region(df)) == [("A",), ("B",)]
    assert rows(op.dim_time(df)) == [(d, 2021, 5, 1)]
    assert rows(op.date_range(fact)) == [(d, d)]
    assert [r[0] for r in op.ranked(fact, d).collect()] == ["A", "B"]


def test_slice_prunes_partitions(spark, tmp_path):
    from stormgrid.sources import write_table
    df = spark.sql(
        "SELECT date'2021-01-01' + CAST(id % 5 AS INT) AS fecha, concat('R', id) AS alcaldia, "
        "0.5D AS probabilidad, 1 AS prediccion, 0 AS valor_real, 'MEDIO' AS riesgo FROM range(50)"
    )
    path = str(tmp_path / "fact")
    write_table(df, path, partition_by=["fecha"])
    day = op.slice_by_date(spark.read.parquet(path), "2021-01-03")
    assert day.count() == 10
    text = plan(day)
    assert "PartitionFilters: [isnotnull(fecha" in text
