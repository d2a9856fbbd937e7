"""Nearest vectors by cosine through low-dimensional stable projections and kd-trees.

Unit vectors are projected on a few Gaussian directions.  A projected squared distance divided by
the true one is chi-square distributed with as many degrees of freedom, so a vector at least as
near as the k-th best so far lies within ``quantile * d_k ** 2`` of the query with probability
``sure``.  Cells, the upper part of a kd-tree over the projections, are the units Spark shuffles; a
cell has its own kd-tree.  Leaves are verified in the order of their projected distance until the
test stops the query: first in the query's own cell, then in the other cells its bound reaches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid.llm.texts import hashed_sample, slices, written
from stormgrid.operators.scale import salted_join

#: Directions of the projection (even), and the probability that a true neighbour passes the test.
DIMS = 8
SURE = 0.95
SEED = 11
#: A cell has about so many rows as long as there are fewer than CELLS cells; beyond that cells
#: grow, and one above MOST_ROWS is cut by a hash.
CELL_ROWS = 1024
CELLS = 256
MOST_ROWS = 131_072
#: Rows whose projections (8 numbers each) the cuts between cells are fitted on.
FIT_ROWS = 32_768
#: Rows of a leaf, queries searched together, and pairs scored together.
LEAF = 128
BLOCK = 256
PAIRS = 65_536
#: Above the rounding of products of unit vectors in single precision.
MARGIN = 1e-5


def chi_square(x: float, dims: int) -> float:
    """Probability that a chi-square variable of an even number of dimensions is at most ``x``."""
    term = total = 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def quantile(sure: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dims) < sure:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < sure else (low, mid)
    return high


def directions(size: int, dims: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dims))


def _matrix(column: pa.Array, dtype=None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype or flat.dtype).reshape(len(column), -1)


def _norms(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return np.sqrt((rows * rows).sum(1))


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halved along the widest side down to ``leaf`` rows."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = points[rows]
        side = int(np.argmax(own.max(0) - own.min(0)))
        rows = rows[np.argpartition(own[:, side], len(rows) // 2)]
        todo += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
    return out


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        p = points[:, d, None]
        out += np.maximum(np.maximum(low[None, :, d] - p, p - high[None, :, d]), 0) ** 2
    return out


class Cuts:
    """The upper kd-tree: which cell a projection falls into."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.side = np.zeros(2 ** depth, np.int64)
        self.at = np.zeros(2 ** depth)
        held = {1: np.arange(len(sample))}
        for node in range(1, 2 ** depth):
            rows = held.pop(node)
            own = sample[rows]
            if len(rows):
                self.side[node] = side = int(np.argmax(own.max(0) - own.min(0)))
                self.at[node] = np.median(own[:, side])
                right = own[:, side] > self.at[node]
                held[2 * node], held[2 * node + 1] = rows[~right], rows[right]
            else:
                held[2 * node] = held[2 * node + 1] = rows

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + (points[rows, self.side[node]] > self.at[node])
        return node - 2 ** self.depth


class Cell:
    """The vectors of a cell and the kd-tree over their projections."""

    def __init__(self, names: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        self.names, self.vectors = names, vectors
        self.norms = _norms(vectors)
        self.unit = (vectors / self.norms[:, None]).astype(np.float32)
        self.leaves = kd_leaves(points, LEAF)
        self.low = np.array([points[r].min(0) for r in self.leaves])
        self.high = np.array([points[r].max(0) for r in self.leaves])

    def _exact(self, vectors, norms, q, c) -> np.ndarray:
        out = np.zeros(len(q))
        for at in range(0, len(q), PAIRS):
            i, j = q[at:at + PAIRS], c[at:at + PAIRS]
            dots = (vectors[i].astype(np.float64) * self.vectors[j].astype(np.float64)).sum(1)
            out[at:at + PAIRS] = dots / (norms[i] * self.norms[j])
        return out

    def search(self, vectors: np.ndarray, points: np.ndarray, bound: np.ndarray, k: int, reach: float):
        """(query, row, cosine) of the best ``k`` rows per query that are not below its ``bound``."""
        norms = _norms(vectors)
        unit = (vectors / norms[:, None]).astype(np.float32)
        far = box_distances(points, self.low, self.high)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        bound = bound.copy()
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        at, step = 0, 1
        while at < len(self.leaves):
            wanted = far[:, at:at + step] <= (reach * np.maximum(2 - 2 * bound, 0))[:, None]
            if not wanted.any():
                break
            found: list[tuple[np.ndarray, np.ndarray]] = []
            pending = 0
            here = order[:, at:at + step]
            for leaf in np.unique(here[wanted]):
                asks = np.flatnonzero(((here == leaf) & wanted).any(1))
                rows = self.leaves[leaf]
                near = unit[asks] @ self.unit[rows].T
                least = bound[asks]
                if len(rows) > k:
                    least = np.maximum(least, np.partition(near, len(rows) - k, axis=1)[:, len(rows) - k])
                i, j = np.nonzero(near >= (least - MARGIN)[:, None])
                found.append((asks[i], rows[j]))
                pending += len(i)
                if pending > 4 * PAIRS:
                    best, bound = self._merge(best, found, vectors, norms, bound, k)
                    found, pending = [], 0
            best, bound = self._merge(best, found, vectors, norms, bound, k)
            at, step = at + step, step * 2
        return best

    def _merge(self, best, found, vectors, norms, bound, k):
        """The best ``k`` per query, ties to the smaller name, and the bounds they set."""
        q, c = (np.concatenate([f[i] for f in found] or [best[0][:0]]) for i in (0, 1))
        score = self._exact(vectors, norms, q, c)
        keep = score >= bound[q]
        q, c, score = (np.concatenate([old, new[keep]]) for old, new in zip(best, (q, c, score)))
        order = np.lexsort((self.names[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        starts = np.searchsorted(q, q, "left")
        place = np.arange(len(q)) - starts
        q, c, score, place = (x[place < k] for x in (q, c, score, place))
        bound = bound.copy()
        last = place == k - 1
        bound[q[last]] = np.maximum(bound[q[last]], score[last])
        return (q, c, score), bound


def usable(vec: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(vec, name, ids, asked): each vector once, with its ``k`` smallest ids and whether it is a query.

    Only ``k`` rows of a group of copies leave a task, however large it is.
    """
    first = Window.partitionBy("vec", "asked").orderBy("id")
    few = rows.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k)
    return few.groupBy("vec").agg(
        F.min("id").alias("name"), F.slice(F.sort_array(F.collect_list("id")), 1, k).alias("ids"),
        F.max("asked").alias("asked"))


def _project(rows: DataFrame, size: int, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        along = directions(size, dims)
        for batch in batches:
            vectors = _matrix(batch.column("vec"), np.float64)
            points = (vectors / _norms(vectors)[:, None]) @ along if len(vectors) else np.zeros((0, dims))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(points), pa.list_(pa.float64()))], [*batch.schema.names, "point"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, point array<double>")


def _placed(points: DataFrame, cuts: Cuts) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cuts.cell(_matrix(batch.column("point"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    schema = ", ".join(f"{c} {t}" for c, t in points.dtypes)
    return points.mapInArrow(run, f"{schema}, cell long")


_FOUND = "asker long, name long, ids array<long>, score double"


def _visit(points: DataFrame, asks: DataFrame, k: int, reach: float) -> DataFrame:
    """Search every query of ``asks`` (asker, vec, point, bound, cell, part) in the rows of its cell and part.

    A cell's rows come first and are held, at most MOST_ROWS or so; its queries pass in batches.
    """
    of_points = points.select("cell", "part", F.lit(0).alias("kind"), "name", "ids", "vec", "point", F.lit(0.0).alias("bound"))
    of_asks = asks.select("cell", "part", F.lit(1).alias("kind"), F.col("asker").alias("name"),
                          F.array().cast("array<long>").alias("ids"), "vec", "point", "bound")
    both = of_points.unionByName(of_asks).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, cell, ids = None, [], None, None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for low, high in zip([0, *cut], [*cut, key.shape[1]]):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                here = tuple(key[:2, low])
                if here != at:
                    at, held, cell = here, [], None
                if key[2, low] == 0:
                    held.append(rows)
                    continue
                if not held:
                    continue
                if cell is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    ids = whole["ids"].combine_chunks()
                    cell = Cell(whole["name"].to_numpy(), _matrix(whole["vec"].combine_chunks()),
                                _matrix(whole["point"].combine_chunks()))
                for block in slices(rows, BLOCK):
                    q, c, score = cell.search(
                        _matrix(block.column("vec")), _matrix(block.column("point")),
                        block.column("bound").to_numpy(zero_copy_only=False), k, reach)
                    yield pa.RecordBatch.from_arrays(
                        [block.column("name").take(pa.array(q)), pa.array(cell.names[c]),
                         ids.take(pa.array(c)), pa.array(score)], ["asker", "name", "ids", "score"])

    return both.mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("asker").orderBy(F.col("score").desc(), "name")
    return found.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def _others(asks: DataFrame, boxes: list, parts: dict[int, int], reach: float) -> DataFrame:
    """Each query once for every other cell and part that its bound reaches."""
    number = np.array([b["cell"] for b in boxes])
    low, high = (np.array([b[side] for b in boxes], np.float64) for side in ("low", "high"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, BLOCK):
                far = box_distances(_matrix(rows.column("point")), low, high)
                bound = rows.column("bound").to_numpy(zero_copy_only=False)
                q, c = np.nonzero(far <= (reach * np.maximum(2 - 2 * bound, 0))[:, None])
                times = np.array([parts[n] for n in number[c].tolist()], np.int64)
                q, cell = np.repeat(q, times), np.repeat(number[c], times)
                part = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                own = (cell == rows.column("cell").to_numpy()[q]) & (part == rows.column("part").to_numpy()[q])
                q, cell, part = q[~own], cell[~own], part[~own]
                taken = rows.select(["asker", "vec", "point", "bound"]).take(pa.array(q))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cell), pa.array(part)], [*taken.schema.names, "cell", "part"])

    kinds = dict(asks.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("asker", "vec", "point", "bound", "cell", "part"))
    return asks.select("asker", "vec", "point", "bound", "cell", "part").mapInArrow(run, schema)


def nearest(
    rows: DataFrame, asked: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
    dims: int = DIMS, sure: float = SURE, cell_rows: int = CELL_ROWS, most_rows: int = MOST_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` vectors with the largest cosine to every query.

    Queries are the rows for which ``asked`` holds; candidates are all rows with another id.  Equal
    cosines go by the smaller id, fewer than ``k`` candidates are all returned.  Rows with a null id,
    with a vector that is null, empty, zero or has a null or non-finite component, or whose length is
    not the most frequent one (the smallest of several), take no part.  Copies of a vector are searched once; rows that
    repeat an id are each a candidate and a query.  An empty table gives no rows.

    Cells the bound reaches are all visited: on vectors without clusters that is most of them, and
    a query is then shuffled once for each of at most ``CELLS`` cells (more only above
    ``CELLS * most_rows`` rows).
    """
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"),
                       F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vec")))
    length = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    size = length["size"] if length else 1
    rows = rows.filter(F.size("vec") == size)
    reach = quantile(sure, dims)
    more = k + 1  # a query's own vector is among them
    # Names are smallest ids, which vectors may share where ids repeat; keys tell vectors apart.
    points = written(_project(_distinct(rows, more), size, dims).withColumn("key", F.monotonically_increasing_id()))
    n = points.count()
    depth = max(0, math.ceil(math.log2(min(CELLS, max(1, n / cell_rows)))))
    sample = hashed_sample(points.select("name", "point"), F.xxhash64("name"), FIT_ROWS) if depth else None
    held = np.array([r["point"] for r in sample.collect()], np.float64) if depth else np.zeros((0, dims))
    placed = _placed(points, Cuts(held, depth))
    # At most CELLS boxes.
    corner = [(F.array(*[f(F.col("point")[d]) for d in range(dims)])) for f in (F.min, F.max)]
    boxes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), corner[0].alias("low"), corner[1].alias("high")).collect()
    parts = {b["cell"]: math.ceil(b["n"] / most_rows) for b in boxes}
    wide = [F.when(F.col("cell") == c, F.lit(p)) for c, p in parts.items() if p > 1]
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.coalesce(*wide, F.lit(1)).cast("long")))
    asks = placed.filter("asked").select(
        F.col("key").alias("asker"), "vec", "point", F.lit(-2.0).alias("bound"), "cell", "part")
    home = written(_visit(placed, asks, more, reach))
    kth = home.groupBy("asker").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_least"))
    kth = kth.filter(F.col("_n") >= more).select("asker", "_least")
    bounded = asks.drop("bound").join(kth, "asker", "left").withColumn("bound", F.coalesce("_least", F.lit(-2.0))).drop("_least")
    found = home
    if sum(parts.values()) > 1:
        found = home.unionByName(_visit(placed, _others(bounded, boxes, parts, reach), more, reach))
    lists = _best(found, more).groupBy("asker").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    lists = points.filter("asked").select(F.col("key").alias("asker"), "vec").join(lists, "asker").drop("asker")
    results = salted_join(rows.filter("asked").select("id", "vec"), lists, ["vec"], "inner")
    pairs = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("less"), i.alias("id")))))
    others = F.filter(pairs, lambda p: p["id"] != F.col("id"))
    ranked = results.select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.array_sort(others), 1, k)).alias("rank", "p"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("p.id").alias("id"), (-F.col("p.less")).alias("score"))
