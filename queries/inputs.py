"""Domain-shaped inputs derived from the driver tables, in Spark and in SQL.

Weather comes from line items, calls from orders, predictions from events, region
polygons from nations.  Measures are whole numbers wherever the engines might add
in a different order, so that sums and means agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid.functions import right_bins
from stormgrid import defaults as D
from stormgrid.sources import with_edges


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


# ---------------------------------------------------------------------------
# Points: a plane of 640 x 640 positions in [0, 10) x [0, 10), exact in binary
# ---------------------------------------------------------------------------
def point(key: str) -> dict[str, Column]:
    k = F.col(key)
    return {
        "lat": F.pmod(k * 13, F.lit(640)) / F.lit(64.0),
        "lon": F.pmod(k * 7 + F.floor(k / 640) * 3, F.lit(640)) / F.lit(64.0),
    }


def point_sql(key: str) -> str:
    return (
        f"(({key} * 13) % 640) / CAST(64.0 AS DOUBLE) AS lat, "
        f"(({key} * 7 + ({key} // 640) * 3) % 640) / CAST(64.0 AS DOUBLE) AS lon"
    )


# ---------------------------------------------------------------------------
# Regions: one polygon per nation on a 5 x 5 chequerboard of 2 x 2 squares
# ---------------------------------------------------------------------------
_SHAPES = [
    [[(0, 0), (2, 0), (2, 2), (0, 2)]],
    [[(0, 0), (2, 0), (2, 2), (0, 2)], [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]],
    [[(0, 0), (2, 0), (2, 2), (1, 0.5), (0, 2)]],
]


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, NOMGEO, geometry, edges, bbox): squares, squares with a hole, notched squares."""
    k = F.col("n_nationkey")
    x0 = F.pmod(k, F.lit(5)) * 2.0
    y0 = F.pmod(F.floor(k / 5), F.lit(5)) * 2.0

    def rings(shape) -> Column:
        return F.array(*[
            F.array(*[F.array(x0 + float(x), y0 + float(y)) for x, y in [*ring, ring[0]]])
            for ring in shape
        ])

    kind = F.pmod(k, F.lit(3))
    shape = (
        F.when(kind == 0, rings(_SHAPES[0])).when(kind == 1, rings(_SHAPES[1]))
        .otherwise(rings(_SHAPES[2]))
    )
    named = table(spark, sf_dir, "nation").select(
        k.alias("ordinal"), F.col("n_name").alias("NOMGEO"), shape.alias("rings")
    )
    return with_edges(named).withColumn(
        "geometry",
        F.concat(
            F.lit('{"type":"Polygon","coordinates":'), F.to_json("rings"), F.lit("}")
        ),
    ).drop("rings")


def _template_edges() -> str:
    rows = []
    for kind, shape in enumerate(_SHAPES):
        for ring in shape:
            for (xa, ya), (xb, yb) in zip(ring, [*ring[1:], ring[0]]):
                rows.append(f"({kind}, {xa}::DOUBLE, {ya}::DOUBLE, {xb}::DOUBLE, {yb}::DOUBLE)")
    return ", ".join(rows)


REGIONS_CTE = f"""
    template(kind, x1, y1, x2, y2) AS (VALUES {_template_edges()}),
    edges AS (
        SELECT n_nationkey AS ordinal, n_name AS name,
               t.x1 + (n_nationkey % 5) * 2 AS x1, t.y1 + ((n_nationkey // 5) % 5) * 2 AS y1,
               t.x2 + (n_nationkey % 5) * 2 AS x2, t.y2 + ((n_nationkey // 5) % 5) * 2 AS y2
        FROM nation JOIN template t ON t.kind = n_nationkey % 3
    )"""


def located_cte(points: str) -> str:
    """``located(lat, lon, alcaldia)`` for the distinct points of a CTE, by brute force."""
    return f"""
    spots AS (SELECT DISTINCT lat, lon FROM {points}),
    tested AS (
        SELECT lat, lon, ordinal, name,
               sum(CASE WHEN (y1 <= lat AND lat < y2
                              AND (x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1) > 0)
                          OR (y2 <= lat AND lat < y1
                              AND (x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1) < 0)
                        THEN 1 ELSE 0 END) % 2 = 1
               OR bool_or((x2 - x1) * (lat - y1) - (lon - x1) * (y2 - y1) = 0
                          AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
                          AND lat BETWEEN least(y1, y2) AND greatest(y1, y2)) AS hit
        FROM spots, edges GROUP BY ALL
    ),
    located AS (
        SELECT lat, lon, arg_min(name, ordinal) AS alcaldia FROM tested WHERE hit GROUP BY lat, lon
    )"""


# ---------------------------------------------------------------------------
# Weather: one raw row per point and shipping day
# ---------------------------------------------------------------------------
def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns with sentinels and unreadable values, as a raw extract has them."""
    items = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("fecha"),
        F.col("l_quantity").cast("long").alias("q"),
        *[c.alias(n) for n, c in point("l_suppkey").items()],
    )
    daily = items.groupBy("lat", "lon", "fecha").agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"),
        F.max("q").alias("hi"), F.min("q").alias("lo"),
    )
    n, q, hi, lo = (F.col(c) for c in ("n", "q", "hi", "lo"))

    def text(c: Column) -> Column:
        return c.cast("string")

    return daily.select(
        F.when(q % 101 == 0, F.lit("20191301")).otherwise(F.col("fecha")).alias("fecha"),
        "lat", "lon",
        F.when(q % 13 == 0, F.lit("-999")).otherwise(text(q % 23)).alias("precip"),
        F.when(q % 17 == 0, F.lit("n/d")).otherwise(text(10 + n)).alias("temp"),
        text(20 + hi).alias("temp_max"),
        F.when(lo % 19 == 0, F.lit("-99")).otherwise(text(lo)).alias("temp_min"),
        text((q * 3) % 100).alias("humedad"),
        text(n).alias("viento"),
        text(hi % 10).alias("viento_max"),
        text(q).alias("radiacion"),
        text(700 + q % 50).alias("presion"),
        text(lo % 12).alias("humedad_especifica"),
        text(hi - lo).alias("punto_rocio"),
    )


WEATHER_CTE = f"""
    items AS (
        SELECT strftime(l_shipdate, '%Y%m%d') AS fecha, CAST(l_quantity AS BIGINT) AS q,
               {point_sql("l_suppkey")}
        FROM lineitem
    ),
    daily AS (
        SELECT lat, lon, fecha, count(*) AS n, CAST(sum(q) AS BIGINT) AS q, max(q) AS hi,
               min(q) AS lo
        FROM items GROUP BY lat, lon, fecha
    ),
    weather_raw AS (
        SELECT CASE WHEN q % 101 = 0 THEN '20191301' ELSE fecha END AS fecha, lat, lon,
               CASE WHEN q % 13 = 0 THEN '-999' ELSE CAST(q % 23 AS VARCHAR) END AS precip,
               CASE WHEN q % 17 = 0 THEN 'n/d' ELSE CAST(10 + n AS VARCHAR) END AS temp,
               CAST(20 + hi AS VARCHAR) AS temp_max,
               CASE WHEN lo % 19 = 0 THEN '-99' ELSE CAST(lo AS VARCHAR) END AS temp_min,
               CAST((q * 3) % 100 AS VARCHAR) AS humedad, CAST(n AS VARCHAR) AS viento,
               CAST(hi % 10 AS VARCHAR) AS viento_max, CAST(q AS VARCHAR) AS radiacion,
               CAST(700 + q % 50 AS VARCHAR) AS presion,
               CAST(lo % 12 AS VARCHAR) AS humedad_especifica,
               CAST(hi - lo AS VARCHAR) AS punto_rocio
        FROM daily
    ),
    {REGIONS_CTE.strip()},
    {located_cte("weather_raw").strip()},
    weather_typed AS (
        SELECT CAST(try_strptime(w.fecha, '%Y%m%d') AS DATE) AS fecha, w.lat, w.lon, l.alcaldia,
               {", ".join(
                   f"CASE WHEN TRY_CAST({m} AS DOUBLE) > -99 THEN TRY_CAST({m} AS DOUBLE) END AS {m}"
                   for m in D.WEATHER_MEASURES)}
        FROM weather_raw w JOIN located l USING (lat, lon)
        WHERE try_strptime(w.fecha, '%Y%m%d') IS NOT NULL
    ),
    weather_clean AS (
        SELECT fecha, lat, lon, alcaldia,
               {", ".join(
                   f"coalesce(last_value({m} IGNORE NULLS) OVER up, "
                   f"first_value({m} IGNORE NULLS) OVER whole) AS {m}"
                   for m in D.WEATHER_MEASURES)}
        FROM weather_typed
        WINDOW up AS (PARTITION BY lat, lon ORDER BY fecha
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               whole AS (PARTITION BY lat, lon ORDER BY fecha
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    )"""


# ---------------------------------------------------------------------------
# Calls: one raw record per order
# ---------------------------------------------------------------------------
def calls_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents, stray blanks, unreadable dates and coordinates, unknown codes."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    incident = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Inundación")
        .when(F.col("o_orderpriority") == "2-HIGH", "  ENCHARCAMIENTO\t")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Aguas   Negras")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Fuga de Agua")
        .when(k % 4 == 0, "Bache")
        .otherwise("Desborde Canal Río Presa")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("F"), k).alias("folio"),
        F.when(k % 31 == 0, "pendiente")
        .when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy")).alias("fecha_creacion"),
        F.when(k % 19 == 0, F.lit(None)).when(k % 23 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" Natión_"), cust % 25)).alias("alcaldia_cierre"),
        F.when(k % 29 == 0, "x")
        .otherwise((F.lit(19.0) + (k % 90 - 5) / F.lit(128.0)).cast("string")).alias("latitud"),
        (F.lit(-98.875) - (k % 70) / F.lit(128.0)).cast("string").alias("longitud"),
        incident.alias("incidente_c4"),
        F.when(F.col("o_orderstatus") == "F", "A")
        .when(F.col("o_orderstatus") == "O", " Afirmativo ").otherwise("N")
        .alias("codigo_cierre"),
    )


CALLS_CTE = """
    calls_raw AS (
        SELECT 'F' || o_orderkey AS folio,
               CASE WHEN o_orderkey % 31 = 0 THEN 'pendiente'
                    WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS fecha_creacion,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
                    ELSE ' Natión_' || (o_custkey % 25) END AS alcaldia_cierre,
               CASE WHEN o_orderkey % 29 = 0 THEN 'x'
                    ELSE CAST(19::DOUBLE + (o_orderkey % 90 - 5) / 128::DOUBLE AS VARCHAR) END
                   AS latitud,
               CAST(-98.875::DOUBLE - (o_orderkey % 70) / 128::DOUBLE AS VARCHAR) AS longitud,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Inundación'
                    WHEN '2-HIGH' THEN E'  ENCHARCAMIENTO\\t' WHEN '3-MEDIUM' THEN 'Aguas   Negras'
                    WHEN '4-NOT SPECIFIED' THEN 'Fuga de Agua'
                    ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'Bache'
                              ELSE 'Desborde Canal Río Presa' END END AS incidente_c4,
               CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN ' Afirmativo ' ELSE 'N' END
                   AS codigo_cierre
        FROM orders
    ),
    calls_typed AS (
        SELECT folio AS id_incidente,
               CAST(coalesce(try_strptime(fecha_creacion, '%Y-%m-%d %H:%M:%S'),
                             try_strptime(fecha_creacion, '%m/%d/%Y')) AS DATE) AS fecha,
               upper(trim(strip_accents(alcaldia_cierre))) AS alcaldia,
               TRY_CAST(latitud AS DOUBLE) AS latitud, TRY_CAST(longitud AS DOUBLE) AS longitud,
               regexp_replace(lower(trim(strip_accents(incidente_c4), E' \\t')), '\\s+', ' ', 'g')
                   AS tipo_incidente,
               lower(trim(codigo_cierre)) AS codigo_cierre
        FROM calls_raw
    ),
    calls_clean AS (
        SELECT * FROM calls_typed
        WHERE tipo_incidente IN ('inundacion', 'encharcamiento', 'aguas negras', 'fuga de agua',
                                 'desborde canal rio presa')
          AND codigo_cierre IN ('a', 'afirmativo') AND fecha IS NOT NULL
          AND alcaldia IS NOT NULL AND alcaldia <> ''
          AND latitud BETWEEN 19.0::DOUBLE AND 19.6::DOUBLE
          AND longitud BETWEEN -99.4::DOUBLE AND -98.9::DOUBLE
    ),
    counted AS (
        SELECT fecha, alcaldia,
               CAST(count(*) FILTER (tipo_incidente = 'aguas negras') AS INTEGER) AS aguas_negras,
               CAST(count(*) FILTER (tipo_incidente = 'desborde canal rio presa') AS INTEGER)
                   AS desborde_canal,
               CAST(count(*) FILTER (tipo_incidente = 'encharcamiento') AS INTEGER)
                   AS encharcamiento,
               CAST(count(*) FILTER (tipo_incidente = 'fuga de agua') AS INTEGER) AS fuga_agua,
               CAST(count(*) FILTER (tipo_incidente = 'inundacion') AS INTEGER) AS inundacion
        FROM calls_clean GROUP BY fecha, alcaldia
    ),
    incidents_daily AS (
        SELECT *, CAST(aguas_negras + desborde_canal + encharcamiento + fuga_agua + inundacion
                       AS INTEGER) AS total_incidentes,
               CAST(inundacion > 0 AS INTEGER) AS hubo_inundacion,
               CAST(aguas_negras + desborde_canal + encharcamiento + fuga_agua + inundacion > 0
                    AS INTEGER) AS hubo_incidente_hidrico
        FROM counted
    )"""


# ---------------------------------------------------------------------------
# Scores and predictions
# ---------------------------------------------------------------------------
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and score per line item; many scores tie."""
    p = F.col("l_discount") * 7 + F.col("l_tax") * 2 + F.col("l_quantity") / 500
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        p.alias("p"),
        (p >= 0.5).cast("int").alias("pred"),
    )


SCORES_CTE = """
    scores AS (
        SELECT *, CAST(p >= CAST(0.5 AS DOUBLE) AS INTEGER) AS pred
        FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
                     CAST(l_returnflag = 'R' AS INTEGER) AS y,
                     l_discount * 7 + l_tax * 2 + l_quantity / 500 AS p
              FROM lineitem)
    )"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several score rows per (day, region), from events; later rows replace earlier."""
    p = F.col("value") / F.lit(512.0)
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("fecha"),
        F.concat(F.lit(" Natión_"), F.col("user_id") % 20).alias("alcaldia"),
        p.alias("probabilidad_lluvia_intensa"),
        F.when(p >= 0.25, "1.0").otherwise("0").alias("prediccion_lluvia_intensa"),
        (F.col("event_type") == "error").cast("int").alias("valor_real"),
        F.lower(right_bins(p, D.RISK_EDGES, D.RISK_LABELS)).alias("riesgo"),
        "ts", "event_id",
    )


FACT_CTE = """
    fact AS (
        SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
               CAST(day(fecha) AS INTEGER) AS dia, alcaldia, probabilidad,
               CAST(probabilidad >= 0.25 AS INTEGER) AS prediccion, valor_real,
               CASE WHEN probabilidad < 0 THEN NULL
                    WHEN probabilidad <= CAST(0.33 AS DOUBLE) THEN 'BAJO'
                    WHEN probabilidad <= CAST(0.66 AS DOUBLE) THEN 'MEDIO'
                    WHEN probabilidad <= 1 THEN 'ALTO' END AS riesgo
        FROM (SELECT CAST(ts AS DATE) AS fecha, 'NATION_' || (user_id % 20) AS alcaldia,
                     value / CAST(512 AS DOUBLE) AS probabilidad,
                     CAST(event_type = 'error' AS INTEGER) AS valor_real,
                     row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id % 20
                                        ORDER BY ts DESC, event_id DESC) AS rn
              FROM events)
        WHERE rn = 1
    )"""
