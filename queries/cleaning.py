"""Scalar functions, coercion, filters and edge formats."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries.inputs import cents, point, point_sql, table
from queries.registry import query
from stormgrid import defaults as D
from stormgrid.functions import (
    at_least, calendar, in_months, log1p0, normalize_ascii, normalize_key, normalize_text,
    parse_day, parse_ymd, to_int, to_number,
)
from stormgrid.functions.text import fold
from stormgrid.operators import (
    difference, distinct_by, drop_null, keep_bbox, keep_nonempty, present, product,
    weighted_sum, zero_fill_int,
)
from stormgrid.session import table_path
from stormgrid.sources import explode_parameters, grid, land_batch, read_csv, write_table
from stormgrid.streaming.landing import land_payloads


@query("""
    WITH doblado AS (SELECT doc_id, trim(text, E' \\n\\t\\r') AS t FROM documents)
    SELECT doc_id,
           md5(upper(replace(strip_accents(t), 'ß', 'SS'))) AS clave,
           md5(regexp_replace(lower(strip_accents(t)), '\\s+', ' ', 'g')) AS etiqueta,
           md5(upper(regexp_replace(strip_accents(t), '[^\\x00-\\x7F]', '', 'g'))) AS ascii
    FROM doblado
""")
def accent_fold(spark, sf_dir):
    """Folded once behind a generator: folding what is folded is a length comparison."""
    text = F.col("text")
    folded = table(spark, sf_dir, "documents").select(
        F.inline(F.array(F.struct("doc_id", fold(text).alias("text")))))
    return folded.select(
        "doc_id",
        F.md5(normalize_key(text)).alias("clave"),
        F.md5(normalize_text(text)).alias("etiqueta"),
        F.md5(normalize_ascii(text)).alias("ascii"),
    )


@query("""
    WITH texto AS (
        SELECT o_orderkey AS k,
               CASE WHEN o_orderkey % 7 = 0 THEN '20191301' WHEN o_orderkey % 11 = 0 THEN 'nunca'
                    ELSE strftime(o_orderdate, '%Y%m%d') END AS ymd,
               CASE WHEN o_orderkey % 5 = 0 THEN 'pronto'
                    WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS libre,
               CASE WHEN o_orderkey % 13 = 0 THEN 'n/d'
                    WHEN o_orderkey % 17 = 0 THEN ' 12.5 ' ELSE CAST(o_totalprice AS VARCHAR) END
                   AS monto
        FROM orders
    )
    SELECT k, CAST(try_strptime(ymd, '%Y%m%d') AS DATE) AS dia,
           CAST(coalesce(try_strptime(libre, '%Y-%m-%d %H:%M:%S'),
                         try_strptime(libre, '%m/%d/%Y')) AS DATE) AS dia_libre,
           TRY_CAST(trim(monto) AS DOUBLE) AS monto,
           CAST(coalesce(trunc(TRY_CAST(trim(monto) AS DOUBLE)), 0) AS INTEGER) AS entero
    FROM texto
""")
def parse_coerce(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = table(spark, sf_dir, "orders").select(
        k.alias("k"),
        F.when(k % 7 == 0, "20191301").when(k % 11 == 0, "nunca")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("ymd"),
        F.when(k % 5 == 0, "pronto")
        .when(k % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("libre"),
        F.when(k % 13 == 0, "n/d").when(k % 17 == 0, " 12.5 ")
        .otherwise(F.col("o_totalprice").cast("string")).alias("monto"),
    )
    typed = raw.select(
        "k", parse_ymd(F.col("ymd")).alias("dia"), parse_day(F.col("libre")).alias("dia_libre"),
        to_number(F.col("monto")).alias("monto"), to_int(F.col("monto")).alias("entero"),
    )
    return zero_fill_int(typed, ["entero"])


@query("""
    SELECT c_custkey, lat, lon, segmento
    FROM (SELECT c_custkey,
                 CASE WHEN c_custkey % 41 = 0 THEN NULL
                      ELSE 18.9375::DOUBLE + (c_custkey % 96) / CAST(128 AS DOUBLE) END AS lat,
                 -99.5::DOUBLE + (c_custkey % 90) / CAST(128 AS DOUBLE) AS lon,
                 CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS segmento
          FROM customer)
    WHERE lat IS NOT NULL AND segmento <> ''
      AND lat BETWEEN CAST(19.0 AS DOUBLE) AND CAST(19.6 AS DOUBLE)
      AND lon BETWEEN CAST(-99.4 AS DOUBLE) AND CAST(-98.9 AS DOUBLE)
""")
def bbox_filter(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 41 != 0, F.lit(18.9375) + (k % 96) / F.lit(128.0)).alias("lat"),
        (F.lit(-99.5) + (k % 90) / F.lit(128.0)).alias("lon"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
        .alias("segmento"),
    )
    return keep_nonempty(keep_bbox(drop_null(rows, ["lat", "lon"]), "lat", "lon"), "segmento")


@query("""
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS mes,
           CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dia_semana,
           CAST(month(o_orderdate) IN (6, 7, 8, 9, 10) AS INTEGER) AS temporada,
           CAST(o_totalprice >= 250000 AS INTEGER) AS alto
    FROM orders
""")
def calendar_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("dia")
    )
    return calendar(rows, "dia").select(
        "o_orderkey", "mes", "trimestre", "dia_semana",
        in_months(F.col("dia"), D.SEASON_MONTHS).alias("temporada"),
        at_least(F.col("o_totalprice"), 250000).alias("alto"),
    )


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber,
           l_quantity - l_discount AS resta, l_quantity * l_tax AS por_impuesto,
           l_quantity * l_extendedprice AS por_precio,
           CAST(0.5 AS DOUBLE) * (l_quantity / CAST(1 AS DOUBLE))
             + CAST(0.3 AS DOUBLE) * (l_discount / CAST(3 AS DOUBLE))
             + CAST(0.2 AS DOUBLE) * (coalesce(CASE WHEN l_tax > 0.02 THEN l_tax END, 0)
                                      / CAST(7 AS DOUBLE)) AS ponderada,
           round(ln(1 + l_quantity), 6) AS cantidad_log,
           round(ln(1 + coalesce(CASE WHEN l_tax > 0.02 THEN l_tax END, 0)), 6) AS impuesto_log
    FROM lineitem
""")
def interactions_log(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("cantidad"),
        F.col("l_extendedprice").alias("precio"), F.col("l_discount").alias("descuento"),
        F.col("l_tax").alias("tasa"),
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("impuesto"),
    )
    rows = difference(rows, {"resta": ("cantidad", "descuento"), "nada": ("cantidad", "falta")})
    rows = product(
        rows, {"por_impuesto": ("cantidad", "tasa"), "por_precio": ("cantidad", "precio")}
    )
    rows = weighted_sum(
        rows, {"cantidad": (0.5, 1), "descuento": (0.3, 3), "impuesto": (0.2, 7)}, "ponderada"
    )
    rows = log1p0(rows, present(rows, ["cantidad", "impuesto", "falta"]))
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", "resta", "por_impuesto", "por_precio",
        "ponderada", F.round("cantidad_log", 6).alias("cantidad_log"),
        F.round("impuesto_log", 6).alias("impuesto_log"),
    )


@query("""
    SELECT l_suppkey, arg_min(l_partkey, (l_partkey, l_orderkey)) AS l_partkey,
           arg_min(l_orderkey, (l_partkey, l_orderkey)) AS l_orderkey
    FROM lineitem GROUP BY l_suppkey
""")
def first_by_key(spark, sf_dir):
    """One deterministic row per key out of many copies."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    return distinct_by(rows, ["l_suppkey"], ["l_partkey", "l_orderkey"])


@query(f"""
    SELECT DISTINCT lat, lon FROM (SELECT {point_sql("o_custkey")} FROM orders)
""")
def distinct_points(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumns(point("o_custkey")).select("lat", "lon")
    return distinct_by(rows, ["lat", "lon"])


@query("""
    WITH malla AS (
        SELECT CAST(r.i AS INTEGER) AS row, CAST(c.i AS INTEGER) AS col,
               CAST(19.03 AS DOUBLE) + r.i * ((CAST(19.03 AS DOUBLE) + CAST(0.009 AS DOUBLE))
                                              - CAST(19.03 AS DOUBLE)) AS lat,
               CAST(-99.36 AS DOUBLE) + c.i * ((CAST(-99.36 AS DOUBLE) + CAST(0.009 AS DOUBLE))
                                               - CAST(-99.36 AS DOUBLE)) AS lon
        FROM range(63) r(i), range(47) c(i)
    ), cuenta AS (
        SELECT o_custkey % 63 AS row, (o_custkey // 63) % 47 AS col, count(*) AS n
        FROM orders GROUP BY ALL
    )
    SELECT row, col, lat, lon, coalesce(n, 0) AS pedidos FROM malla LEFT JOIN cuenta USING (row, col)
""")
def grid_points(spark, sf_dir):
    """The sampling grid with the orders that fall on each of its points."""
    k = F.col("o_custkey")
    counts = table(spark, sf_dir, "orders").groupBy(
        (k % 63).cast("int").alias("row"), (F.floor(k / 63) % 47).cast("int").alias("col")
    ).agg(F.count(F.lit(1)).alias("n"))
    return grid(spark, **D.GRID).join(counts, ["row", "col"], "left").select(
        "row", "col", "lat", "lon", F.coalesce("n", F.lit(0)).alias("pedidos")
    )


def _payloads(spark, sf_dir):
    """One payload document per supplier; its maps have at most one entry per day."""
    daily = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd").alias("f")
    ).agg(F.sum("l_quantity").alias("q"), F.max("l_quantity").alias("hi"))
    maps = daily.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("f", "q"))).alias("rain"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("hi") > 10, F.struct("f", "hi")))
        ).alias("temp"),
    )
    return maps.select(
        F.col("l_suppkey").cast("double").alias("lat"), F.lit(0.5).alias("lon"),
        F.struct(
            F.create_map(F.lit("PRECTOTCORR"), "rain", F.lit("T2M"), "temp").alias("parameter")
        ).alias("properties"),
    )


_PAYLOAD_SQL = """
    SELECT strftime(l_shipdate, '%Y%m%d') AS fecha, CAST(l_suppkey AS DOUBLE) AS lat,
           CAST(0.5 AS DOUBLE) AS lon, sum(l_quantity) AS precip,
           CASE WHEN max(l_quantity) > 10 THEN max(l_quantity) END AS temp,
           CAST(NULL AS DOUBLE) AS presion
    FROM lineitem GROUP BY 1, 2
"""
_PAYLOAD_COLUMNS = ["fecha", "lat", "lon", "precip", "temp", "presion"]


@query(_PAYLOAD_SQL)
def payload_explode(spark, sf_dir):
    return explode_parameters(_payloads(spark, sf_dir)).select(*_PAYLOAD_COLUMNS)


@query(_PAYLOAD_SQL)
def payload_stream_landing(spark, sf_dir):
    """Payload files landed incrementally by a file stream, then read back."""
    source, target, progress = (
        table_path(spark, n) for n in ("payload-in", "payload-out", "payload-progress")
    )
    _payloads(spark, sf_dir).write.json(source)
    land_payloads(spark, source, target, progress, multi_line=False).awaitTermination()
    return spark.read.parquet(target).select(*_PAYLOAD_COLUMNS)


@query("""
    SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'É' || o_orderpriority END AS nota
    FROM orders
""")
def csv_edge(spark, sf_dir):
    """Orders through a Latin-1 CSV file and back, with missing-value words."""
    path = table_path(spark, "orders-csv")
    out = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "5-LOW", "N/A")
        .otherwise(F.concat(F.lit("É"), "o_orderpriority")).alias("nota"),
    )
    write_table(out, path, fmt="csv", encoding="ISO-8859-1")
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.DoubleType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ])
    return read_csv(
        spark, path, schema, encoding="ISO-8859-1", date_cols=["o_orderdate"], multi_line=False
    )


@query("""
    SELECT CAST(ts AS DATE) AS lote, user_id, count(*) AS n,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS centavos
    FROM events GROUP BY ALL
""")
def landed_batches(spark, sf_dir):
    """Daily batches landed in one folder each; rerunning them replaces, not appends."""
    path = table_path(spark, "events-landed")
    rows = table(spark, sf_dir, "events").groupBy(
        F.to_date("ts").alias("lote"), "user_id"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("centavos"))
    land_batch(rows, path, "lote")
    land_batch(rows.filter(F.dayofmonth("lote") <= 10), path, "lote")
    return spark.read.parquet(path)
