"""Counts, shares, distincts, ranges and missing values."""

from pyspark.sql import functions as F

from queries.inputs import cents, table
from queries.registry import query
from stormgrid.operators import (
    bounds, count_by, count_distinct_by, distinct_sorted, mask_sentinel, null_counts, rate_by,
    sentinel_counts, shape, top_k, totals, value_counts, value_share,
)


@query("""
    SELECT event_type, count(*) AS n,
           round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) * 100, 2) AS pct
    FROM events GROUP BY event_type
""")
def value_share_by_type(spark, sf_dir):
    return value_share(table(spark, sf_dir, "events"), "event_type", digits=2)


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def value_counts_by_flag(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("""
    SELECT l_suppkey, avg(CAST(l_returnflag = 'R' AS INTEGER)) * 100 AS pct
    FROM lineitem GROUP BY l_suppkey
""")
def group_rate(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", (F.col("l_returnflag") == "R").cast("int").alias("devuelto")
    )
    return rate_by(rows, "l_suppkey", "devuelto")


@query("""
    SELECT count(DISTINCT user_id) AS user_id_distinct,
           count(DISTINCT event_type) AS event_type_distinct,
           count(DISTINCT value) AS value_distinct FROM events
""")
def distinct_counts(spark, sf_dir):
    return count_distinct_by(
        table(spark, sf_dir, "events"), ["user_id", "event_type", "value"]
    )


@query("""
    SELECT l_returnflag, count(DISTINCT l_suppkey) AS l_suppkey_distinct,
           count(DISTINCT l_partkey) AS l_partkey_distinct
    FROM lineitem GROUP BY l_returnflag
""")
def distinct_counts_by_group(spark, sf_dir):
    return count_distinct_by(
        table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey"], ["l_returnflag"]
    )


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def counts_in_name_order(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("SELECT DISTINCT p_type FROM part")
def sorted_values(spark, sf_dir):
    return distinct_sorted(table(spark, sf_dir, "part"), "p_type")


@query("""
    SELECT CAST(min(o_orderdate) AS DATE) AS min, CAST(max(o_orderdate) AS DATE) AS max FROM orders
""")
def date_bounds(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dia"))
    return bounds(rows, "dia")


def _gaps(spark, sf_dir):
    """Line items with missing measures: low values count as unusable."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax"
    )
    return mask_sentinel(mask_sentinel(rows, ["l_quantity"], 5), ["l_discount", "l_tax"], 0)


@query("""
    SELECT * FROM (
        SELECT 'l_orderkey' AS "column", count(*) FILTER (l_orderkey IS NULL) AS nulls FROM lineitem
        UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity <= 5) FROM lineitem
        UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount <= 0) FROM lineitem
        UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax <= 0) FROM lineitem)
    ORDER BY nulls DESC, "column" LIMIT 3
""")
def null_report(spark, sf_dir):
    """The columns with the most missing values; the limit is the report's length."""
    return null_counts(_gaps(spark, sf_dir), top=3)


@query("""
    SELECT 'l_quantity' AS "column", count(*) FILTER (l_quantity <= 5) AS invalid FROM lineitem
    UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount <= 5) FROM lineitem
""")
def sentinel_report(spark, sf_dir):
    return sentinel_counts(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], limit=5
    )


@query("""
    SELECT CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS precio,
           sum(l_quantity) AS cantidad FROM lineitem
""")
def column_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        cents("l_extendedprice").alias("precio"), F.col("l_quantity").alias("cantidad")
    )
    return totals(rows, ["precio", "cantidad"])


@query("SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_cols FROM orders")
def table_shape(spark, sf_dir):
    return shape(table(spark, sf_dir, "orders"))


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def top_orders(spark, sf_dir):
    """Top-k report: the limit is the feature."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_k(rows, "o_totalprice", 20, ["o_orderkey"])
