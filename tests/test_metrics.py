"""Scores against direct numpy computations."""

import numpy as np
import pytest

from stormgrid import operators as op
from tests.conftest import plan, rows


def frame(spark, y, p):
    return spark.createDataFrame(
        [(int(a), float(b)) for a, b in zip(y, p)], "y int, p double"
    ).repartition(3)


def f1_sweep(y, p):
    best = (0.0, 0.0)
    for t in np.arange(0.01, 1.00, 0.01):
        hit = p >= t
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        f1 = 0.0 if tp == 0 else 2 * tp / (2 * tp + fp + fn)
        if f1 > best[1]:
            best = (t, f1)
    return best


def auc_pairs(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", range(4))
def test_threshold_equals_the_sweep(spark, seed):
    rng = np.random.default_rng(seed)
    grid = np.arange(0.01, 1.00, 0.01)
    p = np.concatenate([rng.random(200), rng.choice(grid, 200), np.nextafter(rng.choice(grid, 50), 0)])
    y = (rng.random(len(p)) < p * 0.7).astype(int)
    got = op.best_threshold(frame(spark, y, p), "y", "p").first()
    assert (got["threshold"], got["f1"]) == f1_sweep(y, p)


def test_threshold_ties_take_the_lowest_and_nothing_gives_zero(spark):
    tie = op.best_threshold(frame(spark, [1, 0], [0.5, 0.0]), "y", "p").first()
    assert tuple(tie) == (0.01, 1.0)
    assert tuple(op.best_threshold(frame(spark, [0, 0], [0.5, 0.9]), "y", "p").first()) == (0.0, 0.0)
    assert tuple(op.best_threshold(frame(spark, [1], [0.001]), "y", "p").first()) == (0.0, 0.0)


@pytest.mark.parametrize("slice_rows", [4_000_000, 100, 23])
def test_auc_with_ties(spark, slice_rows):
    rng = np.random.default_rng(9)
    p = np.round(rng.random(600), 3)
    y = (rng.random(600) < p).astype(int)
    got = op.roc_auc(frame(spark, y, p), "y", "p", slice_rows).first()["auc"]
    assert got == pytest.approx(auc_pairs(y, p), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert op.roc_auc(frame(spark, [1, 1], [0.1, 0.2]), "y", "p").first()["auc"] is None


def test_metrics_confusion_and_report(spark):
    data = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 4
    df = spark.createDataFrame(data, "y int, h int")
    assert rows(op.confusion(df, "y", "h")) == [(0, 0, 5), (0, 1, 2), (1, 0, 1), (1, 1, 4)]
    assert rows(op.binary_metrics(df, "y", "h")) == [(9 / 12, 4 / 6, 4 / 5, 8 / 11)]
    got = {r["label"]: r for r in op.class_report(df, "y", "h").collect()}
    assert tuple(got["0"])[1:] == (5 / 6, 5 / 7, 10 / 13, 7)
    assert tuple(got["1"])[1:] == (4 / 6, 4 / 5, 8 / 11, 5)
    assert (got["accuracy"]["f1"], got["accuracy"]["support"]) == (0.75, 12)
    assert got["macro avg"]["recall"] == pytest.approx((5 / 7 + 4 / 5) / 2)
    assert got["weighted avg"]["precision"] == pytest.approx((5 / 6 * 7 + 4 / 6 * 5) / 12)


def test_nothing_predicted_gives_zero_not_an_error(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, h int")
    assert rows(op.binary_metrics(df, "y", "h")) == [(1.0, 0.0, 0.0, 0.0)]
    assert sum(r["n"] for r in op.confusion(df, "y", "h").collect()) == 2


def test_scored_rows_are_never_sorted(spark):
    """Only the per-bin and per-score tables reach a window."""
    df = frame(spark, [0, 1], [0.2, 0.8])
    text = plan(op.best_threshold(df, "y", "p"))
    assert text.rindex("Exchange SinglePartition") < text.rindex("HashAggregate")
