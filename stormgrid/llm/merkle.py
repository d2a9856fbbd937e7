"""Merkle manifest of a table: a tree per group, a tree over their roots, and a proof per row.

Leaves are ranked inside their group by range partitioning.  A node carries the interval
``[lo, hi)`` of leaf ranks it covers.  Trees grow in bands of ``BAND`` levels: the nodes of a band
that share an ancestor at its upper end form a block of at most ``2 ** BAND``, so no task holds
more than a block of a tree however many rows one group has.  A node is joined to its ancestors
band by band (equal bucket of ``lo``, interval inside interval); inside a block its sibling at a
level is what its parent's interval holds besides its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid.llm.texts import written
from stormgrid.operators.scale import lookup_join

#: Levels of a tree that one block holds: at most 2 ** BAND nodes meet in one row.
BAND = 8


def record_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 over the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    def up(digest: Column, step: Column) -> Column:
        joined = (
            F.when(step["digest"].isNull(), digest)
            .when(step["left"], F.concat(step["digest"], digest))
            .otherwise(F.concat(digest, step["digest"]))
        )
        return F.sha2(joined, 256)

    return F.aggregate(path, start, up)


def path_hash(path: Column) -> Column:
    """SHA-256 of a path's siblings from the leaf to the root; of nothing where it has none."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), ""), 256)


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 inside each value of ``tree``, by ``order``, nulls first.

    Rows are range-partitioned and sorted, then written, so their places hold; a row's rank is its
    place in its partition plus the rows its tree has in earlier ones.  Equal rows are spread by
    the input partition they came from.
    """
    by = [F.col(c).asc_nulls_first() for c in (tree, *order, "_from")]
    placed = rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()).drop("_from"))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return placed.join(starts, [tree, "_part"]).withColumn(
        "rank", F.col("_before") + F.col("_place") - F.col("_first")
    ).drop("_part", "_place", "_first", "_before")


def _parents(nodes: Column) -> Column:
    """The level above: every two neighbours, or a last one alone, become their hash."""
    def joined(i: Column) -> Column:
        left, right = F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1)
        return F.struct(
            left["lo"].alias("lo"),
            F.coalesce(right["hi"], left["hi"]).alias("hi"),
            F.sha2(F.concat(left["digest"], F.coalesce(right["digest"], F.lit(""))), 256).alias("digest"),
        )

    last = F.floor((F.size(nodes) - 1) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), last), joined)


def _own_path(levels: Column, i: Column) -> Column:
    """Siblings of a block's ``i``-th node and of its ancestors inside the block, level by level."""
    def sibling(level: Column) -> Column:
        own = F.get(F.get(levels, level), _halved(i, level))
        parent = F.get(F.get(levels, level + 1), _halved(i, level + 1))
        run = F.slice(F.get(levels, level), 2 * _halved(i, level + 1) + 1, 2)
        inside = F.filter(run, lambda x: (x["lo"] >= parent["lo"]) & (x["hi"] <= parent["hi"]) & (x["lo"] != own["lo"]))
        other = F.get(inside, F.lit(0))
        return F.struct((other["lo"] < own["lo"]).alias("left"), other["digest"].alias("digest"))

    steps = F.sequence(F.lit(0), F.size(levels) - 2)
    nothing = F.filter(F.transform(F.sequence(F.lit(0), F.lit(0)), sibling), lambda _: F.lit(False))
    return F.when(F.size(levels) > 1, F.transform(steps, sibling)).otherwise(nothing)


def _halved(i: Column, times: Column) -> Column:
    return F.floor(i / F.pow(F.lit(2.0), times)).cast("int")


def _width(band: int) -> int:
    return 1 << (BAND * band)


def _count_at(band: int) -> Column:
    """Nodes a tree of ``n`` leaves has at the lower end of a band."""
    return F.ceil(F.col("n") / F.lit(float(_width(band)))).cast("long")


def _blocks(nodes: DataFrame, counts: DataFrame, band: int) -> DataFrame:
    """One row per block of a band: its ``members`` and all nodes above them, ``levels``.

    A tree that ends inside the band gets no more levels than it needs.
    """
    held = ["lo", *(c for c in nodes.columns if c not in ("tree", "lo"))]
    members = F.sort_array(F.collect_list(F.struct(*held)))
    upper = F.floor(F.col("lo") / F.lit(float(_width(band + 1)))).cast("long")
    grouped = nodes.groupBy("tree", upper.alias("bucket")).agg(members.alias("members"))
    here = _count_at(band)
    height = F.when(here <= 1, 0).otherwise(F.least(F.lit(BAND), F.length(F.bin(here - 1)))).alias("height")
    grouped = lookup_join(grouped, counts.select("tree", height, (here <= (1 << BAND)).alias("ends")), ["tree"])
    own = F.transform("members", lambda m: F.struct(m["lo"].alias("lo"), m["hi"].alias("hi"), m["digest"].alias("digest")))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.greatest("height", F.lit(1))), F.array(own),
        lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1)))))
    levels = F.when(F.col("height") > 0, grown).otherwise(F.array(own))
    return grouped.select("tree", "bucket", "ends", "members", levels.alias("levels"))


def _trees(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The bands of all trees over ``nodes`` (tree, lo, hi, digest, ...), lowest first, and their roots."""
    counts = written(nodes.groupBy("tree").agg((F.max("lo") + 1).alias("n")))
    most = counts.agg(F.max("n")).first()[0] or 1
    bands, roots, band = [], None, 0
    while not band or most > _width(band):
        blocks = written(_blocks(nodes, counts, band))
        top = F.element_at("levels", -1)[0]
        tops = blocks.select("tree", "ends", top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("digest"))
        ended = tops.filter("ends").drop("ends")
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = tops.filter(~F.col("ends")).drop("ends")
        bands.append(blocks)
        band += 1
    return bands, roots


def _paths(bands: list[DataFrame], above: DataFrame) -> DataFrame:
    """Members of the lowest band with their whole path; ``above`` has a root's path to add, by tree."""
    known = above.columns
    upper = None  # members of the band above, with their paths
    for band in range(len(bands) - 1, -1, -1):
        blocks = bands[band]
        ended = lookup_join(blocks.filter("ends"), above, ["tree"])
        if upper is not None:
            # Containment: a block's nodes lie inside the member of the next band with its bucket.
            inner = blocks.filter(~F.col("ends")).withColumn("_lo", F.col("members")[0]["lo"])
            around = upper.select(
                *known, F.floor(F.col("lo") / F.lit(float(_width(band + 1)))).cast("long").alias("bucket"),
                F.col("lo").alias("_from"), F.col("hi").alias("_to"))
            held = inner.join(around, ["tree", "bucket"]).filter((F.col("_lo") >= F.col("_from")) & (F.col("_lo") < F.col("_to")))
            ended = ended.unionByName(held.drop("_lo", "_from", "_to"))
        rows = ended.select(*[c for c in known if c != "path"], "path", "levels", F.posexplode("members").alias("_i", "_m"))
        upper = rows.select(
            *[c for c in known if c != "path"], "_m.*",
            F.concat(_own_path(F.col("levels"), F.col("_i")), "path").alias("path"))
    return upper


def manifest(docs: DataFrame, group: str, order: str, leaf: Column, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``rank``, ``leaf``, ``path``, ``subroot``, ``root``, carried columns.

    Rows of a group ascend by ``order``, nulls first, ties by their leaf.  ``path`` is the list of
    siblings from the leaf over the group's root to the root, each with ``left`` (it stands before
    the node) and ``digest``, which is null where a node is hashed alone.  Groups ascend bytewise,
    null first, and are a tree of their own; null is a group.  An empty table has no rows.
    """
    extra = {f"_{i}": c for i, c in enumerate((carry or {}).values())}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"), F.col(order).alias("_order"), leaf.alias("digest"), *[c.alias(k) for k, c in extra.items()])
    placed = ranked(leaves, "tree", ["_order", "digest"])
    nodes = placed.select(
        "tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", F.col("digest").alias("leaf"), *extra)
    bands, subroots = _trees(nodes)
    subroots = written(subroots.select("tree", F.col("digest").alias("subroot")))
    whole = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest")),
                   "tree", ["name"])
    top, root = _trees(whole.select("tree", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "name"))
    none = _own_path(F.array(F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit("").alias("digest")))), F.lit(0))
    over = _paths(top, root.select("tree", F.col("digest").alias("root"), none.alias("path")))
    above = written(over.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", "path"))
    found = _paths(bands, above)
    return found.select(
        F.col("lo").alias("rank"), "leaf", "path", "subroot", "root",
        *[F.col(k).alias(name) for k, name in zip(extra, carry or {})])


def nodes_of(bands: list[DataFrame]) -> DataFrame:
    """Every node of the trees: (tree, level, lo, hi, digest), leaves at level 0."""
    out = None
    for band, blocks in enumerate(bands):
        levels = blocks.select("tree", F.posexplode("levels").alias("level", "nodes"))
        if band:
            levels = levels.filter("level > 0")  # level 0 is the top of the band below
        rows = levels.select("tree", (F.col("level") + band * BAND).alias("level"), F.inline("nodes"))
        out = rows if out is None else out.unionByName(rows)
    return out
