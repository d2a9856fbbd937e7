"""The ways taken beyond the size limits, over the driver tables with small limits."""

from pyspark.sql import functions as F

from queries.inputs import (
    CALLS_CTE, REGIONS_CTE, SCORES_CTE, WEATHER_CTE, calls_raw, cents, located_cte, point, point_sql,
    regions, scores, table, weather_raw,
)
from queries.registry import ORACLES, query
from stormgrid import defaults as D
from stormgrid import operators as op
from stormgrid.operators.model import category_index
from stormgrid.plans.calls import clean_calls
from stormgrid.plans.weather import clean_weather, weather_from_payloads
from stormgrid.session import table_path
from stormgrid.sources import read_regions


@query(ORACLES["event_history"])
def history_sliced(spark, sf_dir):
    """Lags and sums of five hot keys, cut into slices of 500 rows."""
    events = table(spark, sf_dir, "events").withColumn("centavos", cents("value"))
    return op.history(
        events.select("event_id", "event_type", "ts", "centavos"), "event_type", ["ts", "event_id"],
        lags={"centavos": [1]}, sums={"centavos": [3, 7]}, slice_rows=500,
    ).drop("ts")


@query("""
    SELECT event_id, event_type,
           coalesce(last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND CURRENT ROW),
                    first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW
                                                      AND UNBOUNDED FOLLOWING)) AS value
    FROM (SELECT *, CASE WHEN value > 40 THEN value END AS v FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def fill_sliced(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    masked = op.mask_sentinel(events, ["value"], limit=40)
    return op.fill(masked, "event_type", ["ts", "event_id"], ["value"], slice_rows=500).drop("ts")


@query(ORACLES["roc_auc"])
def auc_sliced(spark, sf_dir):
    return op.roc_auc(scores(spark, sf_dir), "y", "p", 200).select(F.round("auc", 9).alias("auc"))


@query(ORACLES["time_split"])
def split_sliced(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dia"))
    early = op.in_first_part(orders, "dia", ["o_orderkey"], slice_rows=500)
    return orders.withColumn("es_train", early.cast("int"))


@query("""
    SELECT event_id, event_type, n.n_name
    FROM events JOIN nation n ON n.n_nationkey = length(event_type)
""")
def salted_attach(spark, sf_dir):
    """Hot keys joined by shuffle, dealt out over salts."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.length("event_type").cast("long").alias("k"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_name")
    return op.lookup_join(events, nations, ["k"], "inner", max_bytes=0, hot_rows=500).drop("k")


_LOCATED = f"""
    WITH {REGIONS_CTE.strip()},
    puntos AS (SELECT o_orderkey, {point_sql("o_custkey")} FROM orders),
    {located_cte("puntos").strip()}
    SELECT o_orderkey, lat, lon, alcaldia FROM puntos JOIN located USING (lat, lon)
"""


def _order_points(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns(point("o_custkey")).select("o_orderkey", "lat", "lon")


@query("""
    SELECT event_id, user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS n
    FROM events
""")
def category_numbers(spark, sf_dir):
    """Numbers of a category as the encoder gives them, joined back to the rows."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return op.lookup_join(events, category_index(events, "user_id").withColumn("n", F.col("n").cast("long")), ["user_id"])


@query(_LOCATED)
def spatial_shuffled(spark, sf_dir):
    """Points and cells both shuffled by cell, as for a cell table too large to broadcast."""
    return op.spatial_join(
        _order_points(spark, sf_dir), regions(spark, sf_dir), "lat", "lon", 0.5, max_bytes=0)


@query(_LOCATED)
def region_geojson(spark, sf_dir):
    """Polygons through two GeoJSON collections and back."""
    shapes = regions(spark, sf_dir).orderBy("ordinal").select("NOMGEO", "geometry", "ordinal")
    kind = F.get_json_object("geometry", "$.type")
    rings = F.get_json_object("geometry", "$.coordinates")
    # Every other polygon as a multipolygon of one part.
    single = F.col("ordinal") % 2 == 0
    shape = F.when(single, kind).otherwise("MultiPolygon")
    feature = F.concat(
        F.lit('{"properties":{"NOMGEO":"'), "NOMGEO", F.lit('"},"geometry":{"type":"'), shape,
        F.lit('","coordinates":'), F.when(single, rings).otherwise(F.concat(F.lit("["), rings, F.lit("]"))), F.lit("}}"))
    path = table_path(spark, "regions")
    half = (F.col("ordinal") >= 13).cast("int")
    collections = shapes.select(half.alias("half"), F.struct("ordinal", feature.alias("f")).alias("x")).groupBy("half").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["f"]), ",").alias("all"))
    for k in (0, 1):
        collections.filter(F.col("half") == k).select(
            F.concat(F.lit('{"features":['), "all", F.lit("]}"))).coalesce(1).write.text(f"{path}/part={k}")
    return op.spatial_join(
        _order_points(spark, sf_dir), read_regions(spark, [f"{path}/part=0", f"{path}/part=1"]), "lat", "lon", 0.5)


@query(f"""
    WITH {WEATHER_CTE}
    SELECT fecha, lat, lon, {", ".join(D.WEATHER_MEASURES)}, alcaldia FROM weather_clean
""")
def weather_text_coords(spark, sf_dir):
    """Coordinates as text, written in two ways, with rows whose position cannot be read."""
    raw = weather_raw(spark, sf_dir)
    text = raw.withColumns({
        "lat": F.when(F.xxhash64("fecha") % 2 == 0, F.col("lat").cast("string"))
        .otherwise(F.concat(F.col("lat").cast("string"), F.lit("0"))),
        "lon": F.concat(F.lit(" "), F.col("lon").cast("string")),
    })
    lost = text.withColumn("lat", F.lit("n/d"))
    return clean_weather(text.unionByName(lost), regions(spark, sf_dir), 0.5, slice_rows=None)


@query(f"WITH {CALLS_CTE} SELECT * FROM calls_clean")
def calls_day_first(spark, sf_dir):
    """Days written day first, read with that format named first."""
    raw = calls_raw(spark, sf_dir)
    day = F.coalesce(F.try_to_timestamp("fecha_creacion", F.lit("yyyy-MM-dd HH:mm:ss")),
                     F.try_to_timestamp("fecha_creacion", F.lit("M/d/yyyy")))
    first = raw.withColumn("fecha_creacion", F.coalesce(F.date_format(day, "dd/MM/yyyy HH:mm"), "fecha_creacion"))
    return clean_calls(first, day_formats=["dd/MM/yyyy HH:mm", *D.DAY_FORMATS])


@query(f"""
    WITH {REGIONS_CTE.strip()},
    puntos AS (
        SELECT DISTINCT l_suppkey, {point_sql("l_suppkey")} FROM lineitem
    ),
    {located_cte("puntos").strip()}
    SELECT strftime(l_shipdate, '%Y%m%d') AS fecha, p.lat, p.lon, g.alcaldia,
           sum(l_quantity) AS precip, max(l_quantity) AS temp
    FROM lineitem JOIN puntos p USING (l_suppkey) JOIN located g ON g.lat = p.lat AND g.lon = p.lon
    GROUP BY ALL
""")
def payload_weather(spark, sf_dir):
    """Payload documents to raw point-days of the points inside a region."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd").alias("f"), F.col("l_quantity").alias("q"))
    days = items.groupBy("l_suppkey", "f").agg(F.sum("q").alias("rain"), F.max("q").alias("temp"))
    documents = days.groupBy("l_suppkey").agg(F.struct(F.create_map(
        F.lit("PRECTOTCORR"), F.map_from_entries(F.collect_list(F.struct("f", "rain"))),
        F.lit("T2M"), F.map_from_entries(F.collect_list(F.struct("f", "temp"))),
    ).alias("parameter")).alias("properties"))
    payloads = documents.withColumns(point("l_suppkey")).select("lat", "lon", "properties")
    inside = op.spatial_join(payloads.select("lat", "lon").distinct(), regions(spark, sf_dir), "lat", "lon", 0.5)
    return weather_from_payloads(payloads, inside).select("fecha", "lat", "lon", "alcaldia", "precip", "temp")
