"""Nearest vectors against brute force, the test's probability, and rows that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.llm.projected_ann import Cuts, box_distances, chi_square, kd_leaves, nearest, quantile

SCHEMA = "vec_id long, embedding array<float>, score double, rank string"


def brute(rows, k=5, every=5):
    """(query, rank, id, score) with all cosines in double precision."""
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows
            if i is not None and v is not None and None not in v and len(v) and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for i, v in good:
        if i % every:
            continue
        found = sorted((-float((v * w).sum() / (math.sqrt((v * v).sum()) * math.sqrt((w * w).sum()))), j) for j, w in good if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return out


def search(spark, rows, parts=3, every=5, **more):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0.5, "r") for i, v in rows], SCHEMA)
    found = nearest(frame.repartition(parts), F.col("vec_id") % every == 0, **more)
    assert found.columns == ["query_id", "rank", "id", "score"]
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert all(abs(g[3] - w[3]) < 1e-12 for g, w in zip(got, sorted(want)))


@pytest.mark.parametrize("dims", [2, 6, 8])
def test_chi_square(dims):
    draws = (np.random.default_rng(0).standard_normal((200_000, dims)) ** 2).sum(1)
    for sure in (0.5, 0.95):
        at = quantile(sure, dims)
        assert abs(chi_square(at, dims) - sure) < 1e-9 and abs((draws <= at).mean() - sure) < 0.01


def test_kd_tree_holds_every_row_once():
    points = np.random.default_rng(1).standard_normal((1000, 4))
    leaves = kd_leaves(points, 32)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= 32
    same_points = kd_leaves(np.zeros((100, 2)), 8)
    assert sorted(np.concatenate(same_points).tolist()) == list(range(100))


def test_box_distances():
    got = box_distances(np.array([[0.0, 0.0], [3.0, 1.0]]), np.array([[1.0, -1.0]]), np.array([[2.0, 1.0]]))
    assert got.tolist() == [[1.0], [1.0]]


def test_cells_are_even():
    points = np.random.default_rng(2).standard_normal((4096, 3))
    counts = np.bincount(Cuts(points, 4).cell(points), minlength=16)
    assert counts.min() > 240 and counts.max() < 272


@pytest.mark.parametrize("cell_rows,most_rows", [(10 ** 6, 10 ** 6), (64, 20)])
def test_recall_on_vectors_without_clusters(spark, cell_rows, most_rows):
    """The hardest case: independent directions.  The scores of what is found are exact."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24)) for i in range(1000)]
    got, want = search(spark, rows, cell_rows=cell_rows, most_rows=most_rows), brute(rows)
    assert len(got) == len(want)
    found, true = {g[0]: set() for g in got}, {(w[0], w[2]): w[3] for w in want}
    hits = sum((g[0], g[2]) in true for g in got)
    assert hits / len(want) >= 0.93 and len(found) == 200
    assert all(abs(true[g[0], g[2]] - g[3]) < 1e-12 for g in got if (g[0], g[2]) in true)


def test_clusters_over_cells(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16))
    rows = [(i, centres[i % 20] + 0.05 * rng.standard_normal(16)) for i in range(800)]
    got, want = search(spark, rows, cell_rows=50), brute(rows)
    true = {(w[0], w[2]) for w in want}
    assert sum((g[0], g[2]) in true for g in got) / len(want) >= 0.93


def test_copies_ties_and_scaled_copies(spark):
    """A vector many rows share: equal cosines go by the smaller id, a query's own row is left out."""
    rows = [(i, [1, 2, 0]) for i in range(60)] + [(100 + i, [2.0 ** i, 0, 0]) for i in range(12)] + [(200, [1, 2, 0.5]), (205, [0, 0, 1])]
    same(search(spark, rows), brute(rows))
    same(search(spark, rows, cell_rows=2), brute(rows))


def test_one_vector_holds_a_third(spark):
    rng = np.random.default_rng(5)
    rows = [(i, np.ones(8) if i % 3 else rng.standard_normal(8)) for i in range(600)]
    got = search(spark, rows, cell_rows=32)
    for q in (r[0] for r in rows if r[0] % 5 == 0 and r[0] % 3):
        assert [g[2] for g in got if g[0] == q] == [i for i in (1, 2, 4, 5, 7, 8) if i != q][:5]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (1, None), (2, []), (3, [0, 0]), (4, [None, 1]), (5, [nan, 1]), (6, [inf, 1]), (7, [1, 1]), (None, [1, 0]),
            (10, [0, 1]), (11, [1, 2, 3]), (15, [0, 0])]
    got = search(spark, rows)
    assert [g[:3] for g in got] == [(0, 1, 7), (0, 2, 10), (10, 1, 7), (10, 2, 0)]


def test_repeated_ids_and_no_rows(spark):
    got = search(spark, [(5, [1, 0]), (5, [1, 0]), (5, [0, 1]), (6, [1, 1])])
    assert [g[:3] for g in got] == [(5, 1, 6)] * 3
    assert search(spark, []) == [] and search(spark, [(5, [1, 0])]) == [] and search(spark, [(1, [1.0]), (2, [2.0])]) == []
