import random

import numpy as np
from pyspark.sql import functions as F

from stormgrid.llm.quality_gam import FEATURES, PAIR_BINS, BINS, features, fit, quality_scores


def test_additive_and_pairwise_effects():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 4))
    chance = 1 / (1 + np.exp(-(6 * (x[:, 0] > 0.5) - 3 + 4 * np.where((x[:, 1] > 0.5) == (x[:, 2] > 0.5), 1, -1))))
    y = (rng.random(6000) < chance).astype(float)
    model = fit(x[:4000], y[:4000])
    assert (1, 2) in [(i, j) for i, j, _ in model.pairs]
    score = model.score(x[4000:])
    right = (score >= 0.5) == (chance[4000:] >= 0.5)
    assert right.mean() > 0.95
    # Scores are sums of table entries.
    bins = model.bins(x[:5])
    total = [model.base + sum(t[bins[r, k]] for k, t in enumerate(model.tables))
             + sum(t[bins[r, i] * PAIR_BINS // BINS, bins[r, j] * PAIR_BINS // BINS] for i, j, t in model.pairs) for r in range(5)]
    assert np.allclose(model.score(x[:5]), 1 / (1 + np.exp(-np.array(total))))


def test_constant_without_two_labels():
    none = fit(np.zeros((0, 3)), np.zeros(0))
    assert none.score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (fit(np.ones((5, 3)), np.ones(5)).score(np.ones((2, 3))) > 0.5).all()


def test_features_of_awkward_texts():
    for text in ("", " \n", "x", "漢字", "A\nB\nA", "a " * 5000):
        found = features(text)
        assert len(found) == len(FEATURES) and np.isfinite(found).all()


def test_held_out_rows(spark, awkward):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("the of and to in".split()) + rng.choice(["", "ing", "."]) for _ in range(60))
    bad = lambda: " ".join(w + "$$" for w in good().split())
    texts = [(1000 + i, good() if i % 3 else bad()) for i in range(300)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").unionByName(awkward, allowMissingColumns=True)
    labels = spark.createDataFrame(
        [(1000 + i, int(i % 3 > 0)) for i in range(300)] + [(1000, None), (1001, 1), (None, 1), (5, 1)], "doc_id long, quality int")
    out = quality_scores(rows, labels, F.col("doc_id") % 4 != 0).collect()
    assert len(out) == rows.count() and all(0 <= r["score"] <= 1 for r in out)
    held = [r for r in out if (r["doc_id"] or 0) >= 1000 and r["doc_id"] % 4 == 0]
    assert np.mean([(r["score"] >= 0.5) == ((r["doc_id"] - 1000) % 3 > 0) for r in held]) > 0.97


def test_empty_tables(nothing, awkward):
    labels = awkward.selectExpr("doc_id", "cast(null as int) as quality")
    assert len({r["score"] for r in quality_scores(awkward, labels, F.lit(True)).collect()}) == 1
    assert quality_scores(nothing, labels, F.lit(True)).count() == 0
