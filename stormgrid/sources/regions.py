"""Region polygons as edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_FEATURES = """
    features array<struct<
        properties: map<string, string>,
        geometry: struct<type: string, coordinates: string>
    >>
"""


def with_edges(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add ``edges`` and ``bbox`` from rings of [x, y] positions.

    Holes and the parts of a multipolygon are simply more rings: the even-odd
    rule needs no roles.  A ring that does not repeat its first position is closed.
    """
    def ring_edges(ring):
        return F.transform(
            ring,
            lambda p, i: F.struct(
                p[0].alias("x1"), p[1].alias("y1"),
                F.try_element_at(ring, F.pmod(i + 1, F.size(ring)) + 1)[0].alias("x2"),
                F.try_element_at(ring, F.pmod(i + 1, F.size(ring)) + 1)[1].alias("y2"),
            ),
        )

    def is_segment(e):
        return (e["x1"] != e["x2"]) | (e["y1"] != e["y2"])

    edges = F.filter(F.flatten(F.transform(F.col(rings), ring_edges)), is_segment)
    xs, ys = F.transform("edges", lambda e: e["x1"]), F.transform("edges", lambda e: e["y1"])
    return df.withColumn("edges", edges).withColumn(
        "bbox",
        F.struct(
            F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"),
        ),
    )


def read_regions(spark: SparkSession, path: str, name_field: str = "NOMGEO") -> DataFrame:
    """(ordinal, <name_field>, geometry, edges, bbox) from GeoJSON feature collections.

    ``ordinal`` is the position in the collection; over several files it goes on in
    the order of their names.  ``geometry`` keeps the GeoJSON text for serving.  A
    collection is read as one row, so its features are dealt out before anything
    is computed from them.
    """
    files = spark.read.schema(_FEATURES).option("multiLine", True).json(path).select(
        F.input_file_name().alias("file"), "features"
    )
    sizes = files.select("file", F.coalesce(F.size("features"), F.lit(0)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    features = (
        files.select("file", F.posexplode("features").alias("at", "f")).join(starts, "file")
        .select((F.col("start") + F.col("at")).cast("int").alias("ordinal"), "f")
        .repartition("ordinal")
    )
    shape, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = F.from_json(text, "array<array<array<double>>>")
    parts = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    rings = F.when(shape == "Polygon", polygon).when(shape == "MultiPolygon", parts)
    named = features.select(
        "ordinal",
        F.try_element_at(F.col("f.properties"), F.lit(name_field)).alias(name_field),
        F.concat(
            F.lit('{"type":"'), shape, F.lit('","coordinates":'), text, F.lit("}")
        ).alias("geometry"),
        rings.alias("rings"),
    )
    return with_edges(named).drop("rings")
