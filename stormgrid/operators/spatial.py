"""Point-in-polygon as an equality join on grid cells.

Each region is cut into square cells.  A cell keeps only the edges that can
matter for a point inside it: those in its latitude band that are not entirely
to its left (the test ray runs to the right).  A cell no edge touches is decided
once, for the whole cell.  Points join on their cell and test the few edges left.

``spatial_join`` takes the cell size from the caller.  ``spatial_join_adaptive`` finds it: a square
around all regions is quartered as long as many edges touch it, so large regions have large cells
inside and small cells only along their borders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.operators.scale import salted_join
from stormgrid.session import materialize

CELL_TABLE_BYTES = 64 * 1024 * 1024
#: Edges that may touch a cell before it is quartered, and how often a cell is quartered at most.
MOST_EDGES = 16
MOST_DEPTH = 16


def _cross(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _crosses_ray(e: Column, x: Column, y: Column) -> Column:
    up = (e["y1"] <= y) & (y < e["y2"]) & (_cross(e, x, y) > 0)
    down = (e["y2"] <= y) & (y < e["y1"]) & (_cross(e, x, y) < 0)
    return up | down


def _on_edge(e: Column, x: Column, y: Column, tolerance: float) -> Column:
    in_x = x.between(
        F.least(e["x1"], e["x2"]) - tolerance, F.greatest(e["x1"], e["x2"]) + tolerance
    )
    in_y = y.between(
        F.least(e["y1"], e["y2"]) - tolerance, F.greatest(e["y1"], e["y2"]) + tolerance
    )
    if tolerance == 0:
        return in_x & in_y & (_cross(e, x, y) == 0)
    length = F.hypot(e["x2"] - e["x1"], e["y2"] - e["y1"])
    return in_x & in_y & (F.abs(_cross(e, x, y)) <= length * tolerance)


def _inside(edges: Column, x: Column, y: Column) -> Column:
    return F.pmod(F.size(F.filter(edges, lambda e: _crosses_ray(e, x, y))), F.lit(2)) == 1


def covers(edges: Column, x: Column, y: Column, tolerance: float = 0.0) -> Column:
    """Inside by the even-odd rule, or on the border."""
    return F.exists(edges, lambda e: _on_edge(e, x, y, tolerance)) | _inside(edges, x, y)


def _cell(c: Column, cell: float) -> Column:
    return F.floor(c / F.lit(cell))


def region_cells(
    regions: DataFrame, cell: float, tolerance: float = 0.0, name: str = "NOMGEO"
) -> DataFrame:
    """(cx, cy, ordinal, name, whole, edges): the parts of each region per cell."""
    pad = tolerance + cell * 1e-9
    box = F.col("bbox")

    def span(low: str, high: str) -> Column:
        return F.sequence(_cell(box[low] - pad, cell), _cell(box[high] + pad, cell))

    def low(c: str) -> Column:
        return F.col(c) * cell - pad

    def high(c: str) -> Column:
        return (F.col(c) + 1) * cell + pad

    in_band = F.filter(
        "edges",
        lambda e: (F.greatest(e["y1"], e["y2"]) >= low("cy"))
        & (F.least(e["y1"], e["y2"]) <= high("cy")),
    )
    not_left = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= low("cx"))
    touched = F.exists("edges", lambda e: F.least(e["x1"], e["x2"]) <= high("cx"))
    center_x, center_y = (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell
    return (
        regions
        .select("ordinal", F.col(name).alias("name"), "bbox", "edges",
                F.explode(span("miny", "maxy")).alias("cy"))
        .withColumn("edges", in_band)
        .repartition("ordinal", "cy")  # a region's bands spread before its cells are listed
        .select("ordinal", "name", "edges", "cy", F.explode(span("minx", "maxx")).alias("cx"))
        .withColumn("edges", not_left)
        .withColumn("touched", touched)
        .withColumn("whole", ~F.col("touched") & _inside(F.col("edges"), center_x, center_y))
        .filter(F.col("touched") | F.col("whole"))
        .select(
            "cx", "cy", "ordinal", "name", "whole",
            F.when(F.col("touched"), F.col("edges"))
            .otherwise(F.filter("edges", lambda e: F.lit(False))).alias("edges"),
        )
    )


def spatial_join(
    points: DataFrame,
    regions: DataFrame,
    lat: str,
    lon: str,
    cell: float,
    tolerance: float = 0.0,
    name: str = "NOMGEO",
    out: str = "alcaldia",
    max_bytes: int = CELL_TABLE_BYTES,
) -> DataFrame:
    """Points with the region they fall in; points in no region are dropped.

    A point on a shared border goes to the region with the lowest ordinal.  When
    the cell table is proven small it is broadcast with the candidates of a cell
    in one row, and points are neither shuffled nor multiplied.  Otherwise both
    sides shuffle on the cell, with hot cells salted.
    """
    cells = region_cells(regions, cell, tolerance, name)
    x, y = F.col(lon), F.col(lat)
    keyed = points.withColumns({"cx": _cell(x, cell), "cy": _cell(y, cell)})
    return _located(points, keyed, cells, ["cx", "cy"], lat, lon, tolerance, out, max_bytes)


def _located(
    points: DataFrame, keyed: DataFrame, cells: DataFrame, at: list[str], lat: str, lon: str, tolerance: float,
    out: str, max_bytes: int,
) -> DataFrame:
    """Points, ``keyed`` by the cells ``at`` they may lie in, with the first region that covers them.

    A point has one row in ``keyed`` for which there are cells, or none.
    """
    x, y = F.col(lon), F.col(lat)
    size = cells.agg(
        F.count(F.lit(1)).alias("cells"), F.sum(F.size("edges")).alias("edges"),
        F.sum(F.octet_length("name")).alias("names"),
    ).first()
    if 96 * size["cells"] + 64 * (size["edges"] or 0) + (size["names"] or 0) <= max_bytes:
        by_cell = cells.groupBy(*at).agg(
            F.sort_array(F.collect_list(F.struct("ordinal", "name", "whole", "edges")))
            .alias("parts")
        )
        hits = F.filter(
            "parts", lambda r: r["whole"] | covers(r["edges"], x, y, tolerance)
        )
        return (
            keyed.join(F.broadcast(by_cell), at)
            .withColumn("_hits", hits)
            .filter(F.size("_hits") > 0)
            .withColumn(out, F.col("_hits")[0]["name"])
            .drop(*at, "parts", "_hits")
        )
    located = (
        salted_join(keyed.select(lat, lon, *at).distinct(), cells, at, "inner")
        .filter(F.col("whole") | covers(F.col("edges"), x, y, tolerance))
        .groupBy(lat, lon)
        .agg(F.min(F.struct("ordinal", "name")).alias("_first"))
        .select(lat, lon, F.col("_first.name").alias(out))
    )
    return salted_join(points, located, [lat, lon], "inner")


def _square(regions: DataFrame) -> tuple[float, float, float] | None:
    """(least x, least y, side) of a square with a margin around all regions; None without any."""
    box = F.col("bbox")
    ends = regions.agg(
        F.min(box["minx"]).alias("minx"), F.min(box["miny"]).alias("miny"),
        F.max(box["maxx"]).alias("maxx"), F.max(box["maxy"]).alias("maxy"),
    ).first()
    if ends["minx"] is None:
        return None
    side = max(ends["maxx"] - ends["minx"], ends["maxy"] - ends["miny"]) or 1.0
    return ends["minx"] - side / 64, ends["miny"] - side / 64, side * (1 + 1 / 32)


def _place(c: Column, least: float, side: float, depth: Column) -> Column:
    return F.floor((c - F.lit(least)) / F.lit(side) * F.pow(F.lit(2.0), depth))


def region_tree(
    regions: DataFrame, most_edges: int = MOST_EDGES, most_depth: int = MOST_DEPTH, tolerance: float = 0.0,
    name: str = "NOMGEO",
) -> tuple[DataFrame, tuple[float, float, float]]:
    """((depth, cx, cy, ordinal, name, whole, edges), square): the regions' parts in the cells of a quadtree.

    A cell is quartered while more than ``most_edges`` edges touch it, of all regions together, so
    cells do not overlap and there are at most some multiple of edges times depth of them.
    """
    square = _square(regions)
    least_x, least_y, side = square or (0.0, 0.0, 1.0)
    here = regions.select(
        F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"), "ordinal", F.col(name).alias("name"),
        F.lit(False).alias("whole"), "edges")
    none = F.filter("edges", lambda e: F.lit(False))
    leaves = []
    for depth in range(most_depth + 1):
        cell = side / 2 ** depth
        pad = tolerance + cell * 1e-9

        def low(c: str, least: float) -> Column:
            return F.lit(least) + F.col(c) * cell - pad

        def high(c: str, least: float) -> Column:
            return F.lit(least) + (F.col(c) + 1) * cell + pad

        in_reach = F.filter(
            "edges",
            lambda e: (F.greatest(e["y1"], e["y2"]) >= low("cy", least_y))
            & (F.least(e["y1"], e["y2"]) <= high("cy", least_y))
            & (F.greatest(e["x1"], e["x2"]) >= low("cx", least_x)))
        touching = F.size(F.filter("edges", lambda e: F.least(e["x1"], e["x2"]) <= high("cx", least_x)))
        center_x = F.lit(least_x) + (F.col("cx") + 0.5) * cell
        center_y = F.lit(least_y) + (F.col("cy") + 0.5) * cell
        # A part that no edge touches is inside or outside as a whole, and has no more use for edges.
        cut = here.withColumn("edges", in_reach).withColumn("touching", F.when(F.col("whole"), 0).otherwise(touching))
        inside = (F.col("touching") == 0) & _inside(F.col("edges"), center_x, center_y)
        cut = cut.withColumn("whole", F.col("whole") | inside).filter(F.col("whole") | (F.col("touching") > 0))
        cut = materialize(cut.withColumn("edges", F.when(F.col("whole"), none).otherwise(F.col("edges"))))
        crowded = cut.groupBy("cx", "cy").agg(F.sum("touching").alias("_n")).filter(F.col("_n") > most_edges).select("cx", "cy")
        last = depth == most_depth or crowded.isEmpty()
        own = cut if last else cut.join(crowded, ["cx", "cy"], "left_anti")
        leaves.append(own.select(F.lit(depth).alias("depth"), "cx", "cy", "ordinal", "name", "whole", "edges"))
        if last:
            break
        quarters = F.explode(F.array(*[
            F.struct((F.col("cx") * 2 + i).alias("cx"), (F.col("cy") * 2 + j).alias("cy")) for i in (0, 1) for j in (0, 1)]))
        here = cut.join(crowded, ["cx", "cy"], "left_semi").select(
            quarters.alias("q"), "ordinal", "name", "whole", "edges").select("q.*", "ordinal", "name", "whole", "edges")
    return reduce(DataFrame.unionByName, leaves), (least_x, least_y, side)


def spatial_join_adaptive(
    points: DataFrame,
    regions: DataFrame,
    lat: str,
    lon: str,
    most_edges: int = MOST_EDGES,
    most_depth: int = MOST_DEPTH,
    tolerance: float = 0.0,
    name: str = "NOMGEO",
    out: str = "alcaldia",
    max_bytes: int = CELL_TABLE_BYTES,
) -> DataFrame:
    """``spatial_join`` without a cell size, for regions of any mix of sizes.

    A point is looked up in the cells around it, one for each depth that has cells; cells do not
    overlap, so it meets one of them at most.
    """
    cells, (least_x, least_y, side) = region_tree(regions, most_edges, most_depth, tolerance, name)
    cells = materialize(cells)
    depths = [r["depth"] for r in cells.select("depth").distinct().orderBy("depth").collect()]
    around = points.withColumn("depth", F.explode(F.lit(depths).cast("array<int>")))
    keyed = around.withColumns({
        "cx": _place(F.col(lon), least_x, side, F.col("depth")), "cy": _place(F.col(lat), least_y, side, F.col("depth"))})
    return _located(points, keyed, cells, ["depth", "cx", "cy"], lat, lon, tolerance, out, max_bytes)
