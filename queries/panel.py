"""Counts, joins and time series by region and day."""

from pyspark.sql import functions as F

from queries.inputs import cents, point, point_sql, table
from queries.registry import query
from stormgrid.operators import (
    any_positive, attach, clean_names, crosstab, ensure_columns, fill, history, in_first_part,
    keep_known, keep_values, left_zero, mask_sentinel, mean_by, rename, row_sum,
)

KINDS = ["signup", "purchase", "error", "view"]
NAMES = {"signup": "altas", "purchase": "compras", "error": "errores", "view": "vistas"}


def _zones(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("dia"),
        F.concat(F.lit("ZONA "), F.col("user_id") % 16).alias("zona"),
        "event_type",
        cents("value").cast("double").alias("centavos"),
    )


@query("""
    SELECT dia, zona, altas, compras, errores, vistas, CAST(0 AS INTEGER) AS devoluciones,
           altas + compras + errores + vistas AS total,
           CAST(errores > 0 AS INTEGER) AS hubo_error,
           CAST(altas + compras > 0 AS INTEGER) AS hubo_negocio
    FROM (SELECT CAST(ts AS DATE) AS dia, 'ZONA ' || (user_id % 16) AS zona,
                 count(*) FILTER (event_type = 'signup') AS altas,
                 count(*) FILTER (event_type = 'purchase') AS compras,
                 count(*) FILTER (event_type = 'error') AS errores,
                 count(*) FILTER (event_type = 'view') AS vistas
          FROM events WHERE event_type IN ('signup', 'purchase', 'error', 'view')
          GROUP BY ALL)
""")
def daily_crosstab(spark, sf_dir):
    kept = keep_values(_zones(spark, sf_dir), "event_type", KINDS)
    counts = rename(crosstab(kept, ["dia", "zona"], "event_type", KINDS), NAMES)
    counts = row_sum(ensure_columns(counts, ["devoluciones"]), list(NAMES.values()), "total")
    return any_positive(
        counts, {"hubo_error": ["errores"], "hubo_negocio": ["altas", "compras"]}
    )


@query("""
    SELECT o_orderstatus,
           count(*) FILTER (o_orderpriority = '1-URGENT') AS "1-urgent",
           count(*) FILTER (o_orderpriority = '2-HIGH') AS "2-high",
           count(*) FILTER (o_orderpriority = '3-MEDIUM') AS "3-medium",
           count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS "4-not_specified",
           count(*) FILTER (o_orderpriority = '5-LOW') AS "5-low"
    FROM orders GROUP BY o_orderstatus
""")
def crosstab_found_categories(spark, sf_dir):
    """Categories are not given; the result's column names are cleaned."""
    return clean_names(
        crosstab(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority")
    )


def _orders_panel(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(
        F.to_date("o_orderdate").alias("dia"), F.col("o_orderpriority").alias("grupo")
    ).agg(
        F.count(F.lit(1)).alias("pedidos"), F.sum(cents("o_totalprice")).alias("monto")
    )


@query("""
    WITH panel AS (
        SELECT CAST(o_orderdate AS DATE) AS dia, o_orderpriority AS grupo, count(*) AS pedidos,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS monto
        FROM orders GROUP BY ALL
    )
    SELECT dia, grupo, pedidos, monto,
           lag(pedidos) OVER w AS pedidos_1d, lag(monto) OVER w AS monto_1d,
           CAST(sum(pedidos) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS pedidos_3d,
           CAST(sum(pedidos) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS pedidos_7d,
           CAST(sum(monto) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS monto_14d,
           CAST(sum(monto) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS monto_30d
    FROM panel WINDOW w AS (PARTITION BY grupo ORDER BY dia)
""")
def lag_rolling(spark, sf_dir):
    """Groups of the daily panel are bounded by the calendar: no slicing needed."""
    return history(
        _orders_panel(spark, sf_dir), "grupo", "dia",
        lags={"pedidos": [1], "monto": [1]},
        sums={"pedidos": [3, 7], "monto": [14, 30]}, slice_rows=None,
    )


@query("""
    SELECT event_id, event_type, c AS centavos,
           lag(c) OVER w AS centavos_1d,
           CAST(sum(c) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS centavos_3d,
           CAST(sum(c) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS centavos_7d
    FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def event_history(spark, sf_dir):
    """Event grain with five huge keys: keys beyond the slice size are cut."""
    events = table(spark, sf_dir, "events").withColumn("centavos", cents("value"))
    return history(
        events.select("event_id", "event_type", "ts", "centavos"),
        "event_type", ["ts", "event_id"],
        lags={"centavos": [1]}, sums={"centavos": [3, 7]},
    ).drop("ts")


@query("""
    SELECT event_id, user_id,
           coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND CURRENT ROW),
                    first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW
                                                      AND UNBOUNDED FOLLOWING)) AS value
    FROM (SELECT *, CASE WHEN value > 40 THEN value END AS v FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def fill_gaps(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return fill(
        mask_sentinel(events, ["value"], limit=40), "user_id", ["ts", "event_id"], ["value"]
    ).drop("ts")


@query("""
    WITH medias AS (
        SELECT CAST(ts AS DATE) AS dia, 'ZONA ' || (user_id % 16) AS zona,
               avg(CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE)) AS centavos
        FROM events GROUP BY ALL
    ), cuentas AS (
        SELECT CAST(ts AS DATE) AS dia, 'ZONA ' || (user_id % 16) AS zona,
               count(*) FILTER (event_type = 'purchase') AS purchase,
               count(*) FILTER (event_type = 'error') AS error
        FROM events WHERE event_type IN ('purchase', 'error') GROUP BY ALL
    )
    SELECT dia, zona, centavos, CAST(coalesce(purchase, 0) AS INTEGER) AS purchase,
           CAST(coalesce(error, 0) AS INTEGER) AS error, CAST(0 AS INTEGER) AS refund
    FROM medias LEFT JOIN cuentas USING (dia, zona)
""")
def panel_join(spark, sf_dir):
    rows = _zones(spark, sf_dir)
    counted = crosstab(
        keep_values(rows, "event_type", ["purchase", "error"]),
        ["dia", "zona"], "event_type", ["purchase", "error"],
    )
    means = mean_by(rows, ["dia", "zona"], ["centavos"])
    return left_zero(means, counted, ["dia", "zona"], ["purchase", "error", "refund"])


@query(f"""
    WITH conocidos AS (
        SELECT DISTINCT lat, lon
        FROM (SELECT {point_sql("s_suppkey")} FROM supplier)
    )
    SELECT o_orderkey, lat, lon
    FROM (SELECT o_orderkey, {point_sql("o_custkey")} FROM orders)
    SEMI JOIN conocidos USING (lat, lon)
""")
def known_points(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumns(point("o_custkey"))
    known = table(spark, sf_dir, "supplier").withColumns(point("s_suppkey"))
    return keep_known(rows.select("o_orderkey", "lat", "lon"), known, ["lat", "lon"])


@query("""
    SELECT c_custkey, n_nationkey, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
""")
def attach_region(spark, sf_dir):
    customers = rename(
        table(spark, sf_dir, "customer"), {"c_nationkey": "n_nationkey"}
    ).select("c_custkey", "n_nationkey")
    regions = rename(table(spark, sf_dir, "region"), {"r_regionkey": "n_regionkey"})
    nations = attach(table(spark, sf_dir, "nation"), regions, ["n_regionkey"])
    return attach(customers, nations.drop("n_regionkey"), ["n_nationkey"])


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dia,
           CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey)
                <= floor((SELECT count(*) FROM orders) * CAST(0.8 AS DOUBLE)) AS INTEGER) AS es_train
    FROM orders
""")
def time_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("dia")
    )
    early = in_first_part(orders, "dia", ["o_orderkey"])
    return orders.withColumn("es_train", early.cast("int"))
