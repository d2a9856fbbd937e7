"""Point-in-polygon against brute force in Python, on both join paths."""

import json
import random

import pytest

from stormgrid.operators import region_cells, spatial_join
from stormgrid.sources import grid, read_regions
from tests.conftest import plan, rows

SQUARE = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
NEXT_DOOR = [[[2, 0], [4, 0], [4, 2], [2, 2], [2, 0]]]
NOTCHED = [[[0, 2], [4, 2], [4, 4], [2, 2.5], [0, 4], [0, 2]]]
HOLED = [[[4, 0], [8, 0], [8, 4], [4, 4], [4, 0]], [[5, 1], [7, 1], [7, 3], [5, 3], [5, 1]]]
FAR = [[[20, 20], [21, 20], [20.5, 21]]]  # ring left open
TWO_PARTS = [[[[5.5, 1.5], [6, 1.5], [6, 2], [5.5, 2], [5.5, 1.5]]],
             [[[9, 0], [10, 0.5], [9, 1], [9, 0]]]]
SHAPES = [("Square", "Polygon", SQUARE), ("Next", "Polygon", NEXT_DOOR),
          ("Notched", "Polygon", NOTCHED), ("Holed", "Polygon", HOLED), ("Far", "Polygon", FAR),
          ("Parts", "MultiPolygon", TWO_PARTS)]


def _rings(kind, coords):
    return coords if kind == "Polygon" else [ring for part in coords for ring in part]


def _edges(rings):
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (x1, y1) != (x2, y2):
                yield x1, y1, x2, y2


def _covers(rings, x, y):
    inside = False
    for x1, y1, x2, y2 in _edges(rings):
        cross = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 > y) != (y2 > y) and (cross > 0) == (y2 > y1):
            inside = not inside
    return inside


@pytest.fixture(scope="module")
def regions(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("geo") / "regions.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NOMGEO": n, "id": i},
         "geometry": {"type": kind, "coordinates": coords}}
        for i, (n, kind, coords) in enumerate(SHAPES)
    ]}))
    return read_regions(spark, str(path))


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(5)
    at = {(rng.randint(-8, 88) / 8, rng.randint(-8, 40) / 8) for _ in range(900)}
    at |= {(20.5, 20.5), (21.0, 20.0), (5.75, 1.75)}
    return spark.createDataFrame(sorted(at), "lon double, lat double").repartition(3), sorted(at)


@pytest.mark.parametrize("cell", [0.3, 1.0, 7.0])
@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_spatial_join_equals_brute_force(spark, regions, points, cell, max_bytes):
    df, at = points
    got = {(r["lon"], r["lat"]): r["alcaldia"]
           for r in spatial_join(df, regions, "lat", "lon", cell, max_bytes=max_bytes).collect()}
    want = {}
    for x, y in at:
        hit = [n for n, kind, coords in SHAPES if _covers(_rings(kind, coords), x, y)]
        if hit:
            want[x, y] = hit[0]
    assert got == want


def test_each_point_once_and_payload_kept(spark, regions, points):
    df, _ = points
    twice = df.selectExpr("lat", "lon", "1 AS tag").unionAll(df.selectExpr("lat", "lon", "2 AS tag"))
    small = rows(spatial_join(twice, regions, "lat", "lon", 0.5))
    large = rows(spatial_join(twice, regions, "lat", "lon", 0.5, max_bytes=0))
    assert small == large
    assert len(small) == len(set(small))


def test_tolerance_widens_the_border(spark, regions):
    df = spark.createDataFrame([(-0.01, 1.0)], "lon double, lat double")
    assert spatial_join(df, regions, "lat", "lon", 1.0).count() == 0
    assert spatial_join(df, regions, "lat", "lon", 1.0, tolerance=0.02).count() == 1


def test_cells_inside_a_region_carry_no_edges(spark, regions):
    cells = region_cells(regions.filter("NOMGEO = 'Holed'"), 0.25).collect()
    whole = [c for c in cells if c["whole"]]
    assert whole and all(not c["edges"] for c in whole)
    in_hole = [c for c in cells if 21 <= c["cx"] <= 26 and 5 <= c["cy"] <= 10]
    assert not in_hole


def test_join_is_never_a_nested_loop(spark, regions, points):
    df, _ = points
    for size in (64 << 20, 0):
        text = plan(spatial_join(df, regions, "lat", "lon", 0.5, max_bytes=size))
        assert "NestedLoop" not in text and "CartesianProduct" not in text
    small = plan(spatial_join(df, regions, "lat", "lon", 0.5))
    assert "BroadcastHashJoin" in small


def test_geometry_text_survives(regions):
    shapes = {r["NOMGEO"]: json.loads(r["geometry"]) for r in regions.collect()}
    assert shapes["Holed"]["coordinates"] == HOLED
    assert shapes["Parts"] == {"type": "MultiPolygon", "coordinates": TWO_PARTS}


def test_grid_equals_numpy_ranges(spark):
    import numpy as np
    from stormgrid import defaults as D
    got = grid(spark, **D.GRID).orderBy("row", "col").collect()
    lats = np.arange(D.GRID["miny"], D.GRID["maxy"], D.GRID["step"])
    lons = np.arange(D.GRID["minx"], D.GRID["maxx"], D.GRID["step"])
    assert (len(lats), len(lons)) == (63, 47)
    assert [(r["lat"], r["lon"]) for r in got] == [(a, b) for a in lats for b in lons]
    assert "Cartesian" not in plan(grid(spark, **D.GRID))
    assert grid(spark, 0, 0, 0, 1, 0.5).count() == 0
