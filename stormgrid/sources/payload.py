"""Nested weather payloads: parameter -> (yyyymmdd -> value) maps per point."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import defaults as D
from stormgrid.functions.parse import to_number

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("properties", T.StructType([
        T.StructField(
            "parameter",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())),
        ),
    ])),
])


def read_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One JSON document per line, or per file with ``multi_line``."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", multi_line).json(path)


#: What can be wrong with a document, the first that holds.
PROBLEMS = ["not JSON", "no position", "no parameters", "no days"]
_MISSING_WORDS = [t.upper() for t in D.NULL_TOKENS]


def with_payload(df: DataFrame, document: str, anchor: str = D.PAYLOAD_ANCHOR) -> DataFrame:
    """``df`` with the columns lat, lon, properties, problem, unread of documents given as text.

    Types are not taken on trust: a position or value written as text is read as a number.
    ``problem`` names what makes a document useless, one of ``PROBLEMS`` or null; ``unread`` counts
    values that are neither a number nor a word for a missing one, which become null.

    What several columns need is a column first, so that a document is parsed once and not per use.
    """
    parsed, whole, texts, numbers = (F.col(c) for c in ("_parsed", "_whole", "_texts", "_numbers"))
    lat, lon = F.col("lat"), F.col("lon")
    days = F.try_element_at(numbers, F.lit(anchor))
    odd = F.aggregate(
        F.map_values(texts), F.lit(0).cast("long"),
        lambda n, days: n + F.size(F.filter(F.map_values(days), lambda t: to_number(t).isNull() & ~F.upper(F.trim(t)).isin(_MISSING_WORDS))))
    problem = (
        F.when(parsed.isNull(), PROBLEMS[0]).when(lat.isNull() | lon.isNull(), PROBLEMS[1])
        .when(whole.isNull() | (F.size(texts) == 0), PROBLEMS[2]).when(days.isNull() | (F.size(days) == 0), PROBLEMS[3])
    )
    steps = df.withColumn("_parsed", F.try_parse_json(F.col(document))).withColumns({
        "_whole": F.try_variant_get(parsed, "$.properties.parameter", "map<string,variant>"),
        **{c: to_number(F.try_variant_get(parsed, f"$.{c}", "string")) for c in ("lat", "lon")},
    }).withColumn("_texts", F.map_filter(
        F.transform_values(whole, lambda _, v: F.try_variant_get(v, "$", "map<string,string>")), lambda _, v: v.isNotNull()))
    steps = steps.withColumn(
        "_numbers", F.transform_values(texts, lambda _, days: F.transform_values(days, lambda _, t: to_number(t))))
    return steps.withColumns({
        "properties": F.struct(numbers.alias("parameter")), "problem": problem,
        "unread": F.coalesce(odd, F.lit(0).cast("long")),
    }).drop("_parsed", "_whole", "_texts", "_numbers")


def rescue_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(lat, lon, properties, problem, unread, document, source): every document, none is lost.

    ``read_payloads`` gives nulls where a document is broken or a type is another; here it says
    what is wrong.  ``document`` is kept where it cannot be used, ``source`` is its file.  Blank
    lines are no documents.
    """
    text = spark.read.text(path, wholetext=multi_line).filter(F.trim("value") != "")
    found = with_payload(text.select("value", F.input_file_name().alias("source")), "value")
    unusable = F.when(F.col("problem").isNotNull(), F.col("value"))
    return found.select("lat", "lon", "properties", "problem", "unread", unusable.alias("document"), "source")


def explode_parameters(
    df: DataFrame,
    payload: str = "properties.parameter",
    codes_to_names: Mapping[str, str] = D.WEATHER_CODES,
    anchor: str = D.PAYLOAD_ANCHOR,
) -> DataFrame:
    """One row per (input row, day) with a column per parameter.

    The days are those of the ``anchor`` parameter; a day another parameter lacks
    gives null there.
    """
    maps = F.col(payload)
    top = payload.split(".")[0]
    others = [c for c in df.columns if c != top]
    empty = F.from_json(F.lit("{}"), "map<string,double>")

    def values(code: str) -> Column:
        return F.coalesce(F.try_element_at(maps, F.lit(code)), empty)

    # The parameters' maps are merged day by day, each map once, and days are exploded at the end.
    merged = F.transform_values(values(anchor), lambda _, v: F.struct(F.lit(True).alias("_day")))
    held: list[str] = ["_day"]
    for code, name in codes_to_names.items():
        merged = F.map_zip_with(merged, values(code), _joined(list(held), name))
        held.append(name)
    known = F.map_filter(merged, lambda _, v: v["_day"])
    days = df.select(*others, F.explode(known).alias("fecha", "_values"))
    return days.select("fecha", *others, *[F.col("_values")[n].alias(n) for n in codes_to_names.values()])


def _joined(held: list[str], name: str):
    """Merge of a day's values so far with its value of one more parameter."""
    return lambda _, a, b: F.struct(*[a[h].alias(h) for h in held], b.alias(name))
