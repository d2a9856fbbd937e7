"""Documents that cannot be read, points landed again, counts while writing, open sizes."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from stormgrid import operators as op
from stormgrid.operators import numbers
from stormgrid.operators.spatial import region_tree
from stormgrid.plans.batch import prepare_from_payloads
from stormgrid.plans.profile import StageLog, stage_profile
from stormgrid.sources import explode_parameters, read_payloads, rescue_payloads, with_edges, with_payload
from stormgrid.streaming.landing import land_latest
from tests.conftest import plan, rows

GOOD = {"lat": 19.25, "lon": -99.4, "properties": {"parameter": {"PRECTOTCORR": {"20210101": 1.5, "20210102": -999}, "T2M": {"20210101": 20}}}}


def changed(**more):
    return json.dumps(GOOD | more)


LINES = [
    (json.dumps(GOOD), None, 0),
    (json.dumps(GOOD)[:-3], "not JSON", 0),
    ("", "blank", 0),
    ("null", "no position", 0),
    ("[1, 2]", "no position", 0),
    (changed(lat="n/d"), "no position", 0),
    (changed(lat=None), "no position", 0),
    (changed(lat=" 19.25 ", lon="-99.4"), None, 0),
    (changed(properties=None), "no parameters", 0),
    (changed(properties={"parameter": [1]}), "no parameters", 0),
    (changed(properties={"parameter": {"PRECTOTCORR": 5}}), "no parameters", 0),
    (changed(properties={"parameter": {"T2M": {"20210101": 5}}}), "no days", 0),
    (changed(properties={"parameter": {"PRECTOTCORR": {}}}), "no days", 0),
    (changed(properties={"parameter": {"PRECTOTCORR": {"20210101": "x", "20210102": "2.5", "20210103": None, "20210104": "NaN"}, "T2M": 7}}), None, 1),
]


def test_every_document_is_accounted_for(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text("\n".join(line for line, _, _ in LINES))
    found = rescue_payloads(spark, str(path))
    want = sorted((p or "", u) for line, p, u in LINES if line)
    assert sorted((r["problem"] or "", r["unread"]) for r in found.collect()) == want
    assert found.filter("problem IS NOT NULL AND document IS NULL").count() == 0
    assert found.filter("source NOT LIKE '%p.txt'").count() == 0
    days = explode_parameters(found.filter("problem IS NULL")).select("fecha", "lat", "precip", "temp")
    assert rows(days) == rows(spark.createDataFrame([
        *[("20210101", 19.25, 1.5, 20.0), ("20210102", 19.25, -999.0, None)] * 2,
        ("20210101", 19.25, None, None), ("20210102", 19.25, 2.5, None), ("20210103", 19.25, None, None),
        ("20210104", 19.25, None, None)], days.schema))


def test_sound_documents_read_as_before(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text("\n".join(json.dumps(GOOD | {"lat": 0.1 * i}) for i in range(20)))
    old, new = read_payloads(spark, str(path)), rescue_payloads(spark, str(path))
    assert rows(explode_parameters(old)) == rows(explode_parameters(new).select(*explode_parameters(old).columns))


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(GOOD, indent=2))
    (tmp_path / "b.json").write_text("{\n")
    assert sorted(r["problem"] or "" for r in rescue_payloads(spark, str(tmp_path), multi_line=True).collect()) == ["", "not JSON"]


def test_batch_run_counts_what_it_loses(spark, tmp_path):
    ring = [[[-99.5, 19.0], [-99.25, 19.0], [-99.25, 19.5], [-99.5, 19.5], [-99.5, 19.0]]]
    (tmp_path / "r.geojson").write_text(json.dumps({"features": [
        {"properties": {"NOMGEO": "A"}, "geometry": {"type": "Polygon", "coordinates": ring}}]}))
    codes = {"PRECTOTCORR": 1, "T2M": 20, "RH2M": 50, "WS2M": 3, "ALLSKY_SFC_SW_DWN": 8, "PS": 77}
    days = [(datetime.date(2021, 1, 1) + datetime.timedelta(d)).strftime("%Y%m%d") for d in range(5)]
    good = {"lat": "19.25", "lon": -99.4, "properties": {"parameter": {c: {d: v for d in days} for c, v in codes.items()}}}
    (tmp_path / "p.json").write_text("\n".join([json.dumps(good), json.dumps(good)[:40], json.dumps(good | {"lon": "?"})]))
    (tmp_path / "calls.csv").write_bytes((
        "folio,fecha_creacion,alcaldia_cierre,latitud,longitud,incidente_c4,codigo_cierre\n"
        "f1,2021-01-02 08:00:00,A,19.2,-99.2,Inundación,A\nf2,pendiente,A,19.2,-99.2,Inundación,A\n").encode("latin-1"))
    out = str(tmp_path / "out")
    features = prepare_from_payloads(spark, str(tmp_path / "p.json"), str(tmp_path / "calls.csv"), str(tmp_path / "r.geojson"), out)
    assert features.count() == 5
    profile = {(r["stage"], r["metric"], r["column"]): r["value"] for r in spark.read.parquet(f"{out}/profile").collect()}
    assert profile["payloads", "rows", ""] == "3"
    assert profile["payloads", "lost", "not JSON"] == profile["payloads", "lost", "no position"] == "1"
    assert profile["calls_raw", "rows", ""] == "2" and profile["calls_raw", "unread", "fecha_creacion"] == "1"
    assert profile["calls_clean", "rows", ""] == "1" and profile["features", "rows", ""] == "5"
    assert {s for s, _, _ in profile} == {
        "payloads", "weather_raw", "weather_clean", "calls_raw", "calls_clean", "incidents_daily", "panel", "features"}
    assert sorted(r["problem"] for r in spark.read.parquet(f"{out}/payloads_lost").collect()) == ["no position", "not JSON"]


def test_observed_counts_equal_the_profile_of_the_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [(datetime.date(2021, 1, i % 9 + 1), f"r{i % 3}", i % 5 or None, float(-99 if i % 7 == 0 else i)) for i in range(200)],
        "fecha date, alcaldia string, n int, precip double").repartition(5)
    log = StageLog(spark)
    written = log.written(df, str(tmp_path / "t"), "s")
    seen = {(r["metric"], r["column"]): r["value"] for r in log.table().collect()}
    want = {(r["metric"], r["column"]): r["value"] for r in stage_profile(written).collect() if r["metric"] != "distinct"}
    assert {k: v for k, v in seen.items() if k[0] != "invalid"} == want and seen["invalid", "precip"] == "29"


def test_counts_ride_on_the_write(spark, tmp_path):
    """One job reads the source; no second scan counts it."""
    spark.range(1000).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    log = StageLog(spark)
    watched = log.watch(source, "s")
    assert plan(watched).count("FileScan") == 1 and "CollectMetrics" in plan(watched)
    assert "Exchange" not in plan(watched)


def land(spark, folders):
    query = land_latest(spark, *folders, files_per_batch=2, tile=5.0)
    query.awaitTermination()


def test_a_point_landed_again_replaces_itself(spark, tmp_path):
    folders = [str(tmp_path / n) for n in ("in", "out", "lost", "progress")]
    (tmp_path / "in").mkdir()

    def put(name, lat, days):
        (tmp_path / "in" / name).write_text(json.dumps({"lat": lat, "lon": 1.0, "properties": {"parameter": {"PRECTOTCORR": days}}}))

    for i in range(5):
        put(f"{i}.json", i * 2.0, {"20210101": i, "20210102": i})
    (tmp_path / "in" / "bad.json").write_text("{")
    land(spark, folders)
    first = spark.read.parquet(folders[1])
    assert first.count() == 10 and first.select("tile_lat").distinct().count() == 2
    put("again.json", 2.0, {"20210101": 50, "20210103": 51})
    land(spark, folders)
    got = rows(spark.read.parquet(folders[1]).select("lat", "fecha", "precip"))
    want = [(i * 2.0, d, float(i)) for i in (0, 2, 3, 4) for d in ("20210101", "20210102")] + [(2.0, "20210101", 50.0), (2.0, "20210103", 51.0)]
    assert got == rows(spark.createDataFrame(want, "lat double, fecha string, precip double"))
    lost = spark.read.parquet(folders[2])
    assert rows(lost.select("problem", "value")) == [("not JSON", "{")]
    land(spark, folders)  # nothing new
    assert spark.read.parquet(folders[1]).count() == 10


def test_a_tile_is_one_file_and_a_document_is_parsed_once(spark, tmp_path):
    """40 points in two tiles, landed by one batch: as many files as tiles, not as tasks."""
    folders = [str(tmp_path / n) for n in ("in", "out", "lost", "progress")]
    documents = [json.dumps(GOOD | {"lat": 0.25 * i, "lon": 1.0}) for i in range(40)]
    spark.createDataFrame([(d,) for d in documents], "value string").coalesce(1).write.text(folders[0])
    land_latest(spark, *folders, multi_line=False, tile=5.0).awaitTermination()
    landed = spark.read.parquet(folders[1])
    assert landed.count() == 80 and landed.select(F.input_file_name()).distinct().count() == 2
    assert plan(with_payload(spark.read.text(folders[0]), "value")).lower().count("parsejson") == 1


# ---------------------------------------------------------------------------
# Crosstab, distinct counts, numbers
# ---------------------------------------------------------------------------
def test_crosstab_map(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", None), (None, "x"), ("b", "z")], "k string, c string")
    assert {r["k"]: r["counts"] for r in op.crosstab_map(df, ["k"], "c").collect()} == {"a": {"x": 2, "y": 1}, "b": {"z": 1}}
    many = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 10_000).alias("c"))
    assert [r["n"] for r in op.crosstab_map(many, ["k"], "c").select(F.size("counts").alias("n")).collect()] == [10_000] * 3


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_distinct_counts_by_bitmaps(spark, keys):
    df = spark.range(5000).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("k"), (F.col("id") % 700 - 350).alias("a"), (F.col("id") * 10 ** 9).alias("thin"),
        F.when(F.col("id") % 3 == 1, F.col("id") % 13).cast("int").alias("b"), F.lit(None).cast("long").alias("none"))
    cols = ["a", "thin", "b", "none"]
    got = op.count_distinct_whole(df, cols, keys)
    assert rows(got) == rows(op.count_distinct_by(df, cols, keys).select(*got.columns))
    assert rows(op.count_distinct_whole(df.filter("id < 0" if "id" in df.columns else "a > 10000"), cols, keys)) == (
        [] if keys else [(0, 0, 0, 0)])


def test_bitmaps_do_not_repeat_rows(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("k"), (F.col("id") % 999).alias("a"), (F.col("id") % 555).alias("b"))
    text = plan(op.count_distinct_whole(df, ["a", "b"], ["k"]))
    assert "Expand" not in text and text.count("bitmap_construct_agg") >= 2


def test_only_text_is_parsed(spark):
    df = spark.createDataFrame([("1.5", 2, float("nan"), float("inf")), ("x", None, 3.0, -1.0)], "a string, b int, c double, d double")
    out = numbers(df, ["a", "b", "c", "d"])
    assert rows(out) == rows(spark.createDataFrame([(1.5, 2.0, None, float("inf")), (None, None, 3.0, -1.0)], "a double, b double, c double, d double"))
    assert "rlike" not in plan(numbers(df, ["b", "c", "d"])).lower()


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_values_are_folded_once_each(spark, max_bytes):
    from stormgrid.functions.text import normalize_key, normalize_text
    from stormgrid.operators.joins import fold_values

    df = spark.createDataFrame([(i, [" Ñandú ", "b", None, "É\t x"][i % 4], ["Á", None][i % 2]) for i in range(400)], "id int, a string, b string")
    want = df.withColumns({"a": normalize_text(F.col("a")), "b": normalize_key(F.col("b"))})
    got = fold_values(df, {"a": normalize_text, "b": normalize_key}, max_bytes)
    assert got.columns == df.columns and rows(got) == rows(want)
    assert "translate" not in plan(got)  # the rows themselves are only looked up


def test_day_formats_with_and_without_slash(spark):
    from stormgrid.functions.parse import parse_day

    df = spark.createDataFrame([("2021-01-02",), ("1/2/2021",), ("2021/01/02",), ("02.01.2021",), (None,), ("/",), ("x",)], "t string")
    day = datetime.date(2021, 1, 2)
    assert [r[0] for r in df.select(parse_day(F.col("t"))).collect()] == [day, day, day, None, None, None, None]
    formats = ["dd.MM.yyyy", "d[/]M[/]yyyy", "yyyy-MM-dd"]
    assert [r[0] for r in df.select(parse_day(F.col("t"), formats)).collect()] == [day, datetime.date(2021, 2, 1), None, day, None, None, None]


# ---------------------------------------------------------------------------
# Adaptive cells
# ---------------------------------------------------------------------------
def shapes(spark, items):
    return with_edges(spark.createDataFrame(
        [(i, n, rings) for i, (n, rings) in enumerate(items)], "ordinal int, NOMGEO string, rings array<array<array<double>>>")).drop("rings")


def box(x, y, w, h=None):
    h = h or w
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


@pytest.mark.parametrize("most_edges,most_depth,max_bytes", [(1, 6, 1 << 26), (4, 16, 1 << 26), (4, 16, 0), (10 ** 6, 16, 1 << 26)])
def test_adaptive_cells_agree_with_fixed_ones(spark, most_edges, most_depth, max_bytes):
    regions = shapes(spark, [("big", [box(0.0, 0.0, 8.0), box(3.0, 3.0, 1.0)]), ("small", [box(3.25, 3.25, 0.25)]),
                             ("concave", [[[8.0, 0.0], [10.0, 0.0], [10.0, 2.0], [9.0, 0.5], [8.0, 2.0], [8.0, 0.0]]]), ("far", [box(20.0, 20.0, 0.125)])])
    points = spark.range(4096).select(
        "id", ((F.col("id") % 64) / 6.0).alias("lat"), (F.floor(F.col("id") / 64) / 6.0).alias("lon")).unionByName(
        spark.createDataFrame([(9000, 20.0, 20.125), (9001, 20.0625, 20.0625), (9002, 3.25, 3.25), (9003, 3.0, 3.5), (9004, -50.0, 0.0),
                               (9005, None, 1.0), (9006, 8.0, 8.0), (9007, 1.0, 8.0)], "id long, lat double, lon double"))
    want = op.spatial_join(points, regions, "lat", "lon", 0.5)
    got = op.spatial_join_adaptive(points, regions, "lat", "lon", most_edges, most_depth, max_bytes=max_bytes)
    assert rows(got.select("id", "alcaldia")) == rows(want.select("id", "alcaldia"))


def test_cells_follow_the_edges_not_the_area(spark):
    """A region a thousand times larger adds cells along its border only."""
    small = [(f"s{i}", [box(i * 0.25, 0.0, 0.125)]) for i in range(16)]
    alone, _ = region_tree(shapes(spark, small), most_edges=8)
    both, _ = region_tree(shapes(spark, [*small, ("large", [box(0.0, 0.0, 4000.0)])]), most_edges=8)
    assert alone.count() < 16 * 4 * 16 and both.count() < 20 * 4 * 16
    assert both.agg(F.countDistinct("depth")).first()[0] > 3


def test_no_regions(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id long, lat double, lon double")
    assert op.spatial_join_adaptive(points, shapes(spark, [("a", [box(0.0, 0.0, 1.0)])]).filter("ordinal > 5"), "lat", "lon").count() == 0
