"""Broken inputs, landing again, counts taken while writing, and open or mixed sizes."""

from pyspark.sql import functions as F

from queries.inputs import CALLS_CTE, calls_raw, point, point_sql, table
from queries.registry import query
from stormgrid import operators as op
from stormgrid.functions.parse import parse_day
from stormgrid.functions.text import normalize_key, normalize_text
from stormgrid.plans.calls import clean_calls, daily_incidents
from stormgrid.plans.profile import StageLog
from stormgrid.session import table_path
from stormgrid.sources import explode_parameters, rescue_payloads, with_edges
from stormgrid.streaming.landing import land_latest


# ---------------------------------------------------------------------------
# Payload documents, some of them broken
# ---------------------------------------------------------------------------
def _documents(spark, sf_dir, times=1):
    """(k, document): a payload per supplier as text.

    Every 17th is cut short, every 13th has no readable position, every 7th no parameters, every
    19th no days; every 11th has its position and every 5th its values as text.
    """
    days = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("k"), F.date_format("l_shipdate", "yyyyMMdd").alias("f")
    ).agg((F.sum("l_quantity") * times).alias("rain"), F.max("l_quantity").alias("temp"))
    rain = F.when(F.col("k") % 5 != 0, F.col("rain").cast("string")).when(
        F.col("rain") % 10 == 0, F.lit('"x"')).otherwise(F.concat(F.lit('" '), F.col("rain").cast("string"), F.lit('"')))

    def entries(value):
        line = F.concat(F.lit('"'), F.col("f"), F.lit('":'), value)
        return F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(line)), ","), F.lit("}"))

    k = F.col("k")
    maps = days.groupBy("k").agg(entries(rain).alias("rain"), entries(F.col("temp").cast("string")).alias("temp"))
    position = F.when(k % 13 == 0, '"n/d"').when(k % 11 == 0, F.concat(F.lit('"'), k, F.lit('.0"'))).otherwise(k.cast("string"))
    parameter = F.concat(
        F.lit('{"PRECTOTCORR":'), F.when(k % 19 == 0, "{}").otherwise(F.col("rain")), F.lit(',"T2M":'), "temp", F.lit("}"))
    whole = F.concat(
        F.lit('{"lat":'), position, F.lit(',"lon":0.5'),
        F.when(k % 7 == 0, "").otherwise(F.concat(F.lit(',"properties":{"parameter":'), parameter, F.lit("}"))), F.lit("}"))
    return maps.withColumn("whole", whole).select(
        "k", F.when(k % 17 == 0, F.expr("left(whole, length(whole) - 3)")).otherwise(F.col("whole")).alias("document"))


_DAYS_CTE = """
    days AS (
        SELECT l_suppkey AS k, strftime(l_shipdate, '%Y%m%d') AS fecha, sum(l_quantity) AS rain, max(l_quantity) AS temp
        FROM lineitem GROUP BY 1, 2
    )"""
_PROBLEM_SQL = """
    CASE WHEN k % 17 = 0 THEN 'not JSON' WHEN k % 13 = 0 THEN 'no position' WHEN k % 7 = 0 THEN 'no parameters'
         WHEN k % 19 = 0 THEN 'no days' END"""


def _written_documents(spark, documents):
    path = table_path(spark, "payload-text")
    documents.select("document").write.text(path)
    return path


@query(f"""
    WITH {_DAYS_CTE.strip()}
    SELECT fecha, CAST(k AS DOUBLE) AS lat, CAST(0.5 AS DOUBLE) AS lon,
           CASE WHEN k % 5 = 0 AND rain % 10 = 0 THEN NULL ELSE rain END AS precip, temp
    FROM days WHERE {_PROBLEM_SQL} IS NULL
""")
def payload_rescue(spark, sf_dir):
    """Point-days of the documents that can be used, numbers written as text included."""
    path = _written_documents(spark, _documents(spark, sf_dir))
    good = rescue_payloads(spark, path).filter(F.col("problem").isNull())
    return explode_parameters(good).select("fecha", "lat", "lon", "precip", "temp")


@query(f"""
    WITH {_DAYS_CTE.strip()},
    documents_ AS (
        SELECT k, {_PROBLEM_SQL} AS problem, count(*) FILTER (k % 5 = 0 AND rain % 10 = 0) AS unread FROM days GROUP BY k
    )
    SELECT coalesce(problem, 'none') AS problem, count(*) AS n,
           CAST(sum(CASE WHEN k % 17 = 0 OR k % 7 = 0 OR k % 19 = 0 THEN 0 ELSE unread END) AS BIGINT) AS unread
    FROM documents_ GROUP BY 1
""")
def payload_problems(spark, sf_dir):
    """How many documents and values were lost, and why."""
    found = rescue_payloads(spark, _written_documents(spark, _documents(spark, sf_dir)))
    return found.groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("unread").alias("unread"))


@query(f"""
    WITH {_DAYS_CTE.strip()}
    SELECT fecha, CAST(k AS DOUBLE) AS lat, CAST(0.5 AS DOUBLE) AS lon,
           CASE WHEN k % 5 = 0 AND (rain * CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END) % 10 = 0 THEN NULL
                ELSE rain * CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END END AS precip, temp
    FROM days WHERE {_PROBLEM_SQL} IS NULL
""")
def payload_landed_twice(spark, sf_dir):
    """Every second point is downloaded again with other values; its rows are replaced."""
    source, target, lost, progress = (table_path(spark, n) for n in ("again-in", "again-out", "again-lost", "again-progress"))
    for times, chosen in ((1, F.lit(True)), (2, F.col("k") % 2 == 0)):
        documents = _documents(spark, sf_dir, times).filter(chosen)
        documents.select("document").write.mode("append").text(source)
        land_latest(spark, source, target, lost, progress, multi_line=False, tile=16.0).awaitTermination()
    return spark.read.parquet(target).select("fecha", "lat", "lon", "precip", "temp")


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------
def _profile_sql(stage: str, columns: list[str], numbers: list[str]) -> str:
    out = [f"SELECT '{stage}' AS stage, 'rows' AS metric, '' AS \"column\", CAST(count(*) AS VARCHAR) AS value FROM {stage}"]
    out.append(f"SELECT '{stage}', 'columns', '', '{len(columns)}'")
    out += [f"SELECT '{stage}', 'nulls', '{c}', CAST(count(*) FILTER ({c} IS NULL) AS VARCHAR) FROM {stage}" for c in columns]
    out += [f"SELECT '{stage}', 'total', '{c}', CAST(sum({c}) AS VARCHAR) FROM {stage}" for c in numbers]
    out += [f"SELECT '{stage}', '{f}', 'fecha', CAST({f}(fecha) AS VARCHAR) FROM {stage}" for f in ("min", "max")]
    return " UNION ALL ".join(out)


_CALL_COLUMNS = ["id_incidente", "fecha", "alcaldia", "latitud", "longitud", "tipo_incidente", "codigo_cierre"]
_COUNTS = ["aguas_negras", "desborde_canal", "encharcamiento", "fuga_agua", "inundacion", "total_incidentes",
           "hubo_inundacion", "hubo_incidente_hidrico"]


@query(f"""
    WITH {CALLS_CTE}
    SELECT 'calls_raw' AS stage, 'rows' AS metric, '' AS "column", CAST(count(*) AS VARCHAR) AS value FROM calls_raw
    UNION ALL SELECT 'calls_raw', 'unread', 'fecha_creacion', CAST(count(*) FILTER (fecha IS NULL) AS VARCHAR) FROM calls_typed
    UNION ALL {_profile_sql("calls_clean", _CALL_COLUMNS, [])}
    UNION ALL {_profile_sql("incidents_daily", ["fecha", "alcaldia", *_COUNTS], _COUNTS)}
""")
def stage_counts(spark, sf_dir):
    """Profiles of three stages, counted by the two jobs that write them."""
    log, out = StageLog(spark), table_path(spark, "stages")
    unread = F.count_if(parse_day(F.col("fecha_creacion")).isNull())
    raw = log.watch(calls_raw(spark, sf_dir), "calls_raw", more={("unread", "fecha_creacion"): unread}, every_column=False)
    calls = log.written(clean_calls(raw), f"{out}/calls_clean", "calls_clean")
    log.written(daily_incidents(calls), f"{out}/incidents_daily", "incidents_daily")
    return log.table()


# ---------------------------------------------------------------------------
# Many categories, distinct ids
# ---------------------------------------------------------------------------
@query("""
    WITH counts AS (SELECT l_returnflag, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, count(*) AS n_categories, CAST(sum(n) AS BIGINT) AS n_rows,
           sha256(string_agg(l_orderkey || ':' || n, ',' ORDER BY l_orderkey)) AS entries
    FROM counts GROUP BY l_returnflag
""")
def crosstab_many(spark, sf_dir):
    """Line items by flag and order, with as many categories as orders, in one map a flag."""
    found = op.crosstab_map(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_orderkey")
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return found.select(
        "l_returnflag", F.size("counts").cast("long").alias("n_categories"),
        F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda a, n: a + n).alias("n_rows"),
        F.sha2(F.array_join(entries, ","), 256).alias("entries"))


@query("""
    SELECT count(DISTINCT user_id) AS user_id_distinct, count(DISTINCT event_id) AS event_id_distinct,
           count(DISTINCT user_id * 1000003) AS spread_distinct FROM events
""")
def distinct_ids(spark, sf_dir):
    """By bitmaps; the third column is spread too thin for them."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("user_id") * 1000003).alias("spread"))
    return op.count_distinct_whole(rows, ["user_id", "event_id", "spread"])


@query("""
    SELECT l_returnflag, count(DISTINCT l_suppkey) AS l_suppkey_distinct, count(DISTINCT l_partkey) AS l_partkey_distinct,
           count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey - 3000 END) AS k_distinct
    FROM lineitem GROUP BY l_returnflag
""")
def distinct_ids_by_group(spark, sf_dir):
    """By bitmaps per flag; the third column has negative numbers, and no value for most flags."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_suppkey", "l_partkey", F.when(F.col("l_returnflag") == "R", F.col("l_orderkey") - 3000).alias("k"))
    return op.count_distinct_whole(rows, ["l_suppkey", "l_partkey", "k"], ["l_returnflag"])


@query("""
    SELECT c_custkey, upper(trim(strip_accents(' Región ' || c_mktsegment))) AS segmento,
           lower(trim(strip_accents('Ñ' || (c_nationkey % 7)))) AS zona
    FROM customer
""")
def folded_values(spark, sf_dir):
    """Keys of few values, folded once a value and looked up."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" Región "), "c_mktsegment").alias("segmento"),
        F.concat(F.lit("Ñ"), (F.col("c_nationkey") % 7).cast("string")).alias("zona"))
    return op.fold_values(rows, {"segmento": normalize_key, "zona": normalize_text})


# ---------------------------------------------------------------------------
# Regions of mixed sizes
# ---------------------------------------------------------------------------
def _mixed_regions(spark, sf_dir):
    """One region as large as the plane with a hole in the middle, and a small diamond per nation."""
    k = F.col("n_nationkey")
    x, y = F.pmod(k, F.lit(5)) * 2 + 0.75, F.pmod(F.floor(k / 5), F.lit(5)) * 2 + 0.75
    small = F.array(F.array(
        F.array(x, y - 0.25), F.array(x + 0.25, y), F.array(x, y + 0.25), F.array(x - 0.25, y), F.array(x, y - 0.25)))

    def ring(*corners):
        return F.array(*[F.array(F.lit(float(a)), F.lit(float(b))) for a, b in (*corners, corners[0])])

    large = F.array(ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6)))
    nations = table(spark, sf_dir, "nation")
    shapes = nations.select(k.cast("int").alias("ordinal"), F.col("n_name").alias("NOMGEO"), small.alias("rings"))
    whole = nations.limit(1).select(F.lit(100).alias("ordinal"), F.lit("PLANE").alias("NOMGEO"), large.alias("rings"))
    return with_edges(shapes.unionByName(whole)).drop("rings")


@query(f"""
    WITH puntos AS (SELECT o_orderkey, {point_sql("o_custkey")} FROM orders),
    small AS (
        SELECT n_nationkey AS k, n_name, (n_nationkey % 5) * 2 + 0.75::DOUBLE AS x,
               ((n_nationkey // 5) % 5) * 2 + 0.75::DOUBLE AS y FROM nation
    ),
    inside AS (
        SELECT o_orderkey, arg_min(n_name, k) AS name FROM puntos, small
        WHERE abs(lon - x) + abs(lat - y) <= 0.25::DOUBLE GROUP BY o_orderkey
    )
    SELECT o_orderkey, lat, lon, coalesce(name, 'PLANE') AS alcaldia FROM puntos LEFT JOIN inside USING (o_orderkey)
    WHERE name IS NOT NULL OR NOT (lat > 4 AND lat < 6 AND lon > 4 AND lon < 6)
""")
def spatial_mixed(spark, sf_dir):
    """Points in regions of very different sizes, by cells that are small only where borders are."""
    points = table(spark, sf_dir, "orders").withColumns(point("o_custkey")).select("o_orderkey", "lat", "lon")
    return op.spatial_join_adaptive(points, _mixed_regions(spark, sf_dir), "lat", "lon", most_edges=4)
