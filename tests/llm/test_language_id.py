import random

import numpy as np
from pyspark.sql import functions as F

from stormgrid.llm.language_id import fit, gram_slots, identify

WORDS = {
    "en": "the and with that this have from they been which would there".split(),
    "fr": "les des une que est dans pour avec être cette mais nous".split(),
    "de": "der die und nicht auch wird über sich werden können für".split(),
}


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(lang, " ".join(rng.choice(words) for _ in range(rng.randrange(3, 40)))) for _ in range(n) for lang, words in WORDS.items()]


def test_presence_kernel_by_brute_force():
    texts = ["abcab", "bcd", ""]
    slots = [set(np.concatenate(list(gram_slots(np.frombuffer(t.encode(), np.uint8)))).tolist()) if t else set() for t in texts]
    assert len(slots[0]) == 3 + 3 + 3 + 2  # a b c, ab bc ca, abc bca cab, abca bcab
    model = fit(texts, ["x", "y", "x"], grams=1 << 18, landmarks=3)
    kernel = model.presence(texts) @ model.landmarks
    for i, a in enumerate(slots):
        for j, b in enumerate(slots):
            norm = np.sqrt(max(1, len(a)) * max(1, len(b)))
            assert abs(kernel[i, j] - len(a & b) / norm) < 1e-5


def test_held_out_accuracy():
    train, test = corpus(60), corpus(40, 2)
    model = fit([t for _, t in train], [k for k, _ in train])
    names, score = model.predict([t for _, t in test])
    assert np.mean([n == k for n, (k, _) in zip(names, test)]) > 0.97
    assert ((score >= 0) & (score <= 1)).all()


def test_awkward_rows(spark, awkward):
    rows = spark.createDataFrame([(1000 + i, t, k) for i, (k, t) in enumerate(corpus(30))], "doc_id long, text string, lang string")
    both = rows.unionByName(awkward.withColumn("lang", F.lit(None).cast("string")), allowMissingColumns=True)
    found = identify(both, F.col("doc_id") % 5 != 0, carry=True)
    out = found.collect()
    assert len(out) == both.count() and found.schema["row"].dataType.names == [c for c in both.columns if c != "text"]
    assert sorted(r["text"] or "" for r in out) == sorted(r["text"] or "" for r in both.collect())
    for r in out:
        text = r["text"]
        letters = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (letters or r["score"] == 0)
    good = [r for r in out if (r["doc_id"] or 0) >= 1000]
    assert np.mean([r["lang_pred"] == r["row"]["lang"] for r in good]) > 0.97


def test_nothing_to_learn_from(awkward, nothing):
    assert {r["lang_pred"] for r in identify(awkward, F.lit(False)).collect()} == {"und"}
    assert identify(nothing, F.lit(True)).count() == 0


def test_numbers_are_no_letters(spark):
    """Superscripts, fractions, circled and Roman number characters are no letters; marks and signs neither."""
    texts = ["²³ ½", "①②", "Ⅷ", "12 _ %", "\u0301", "ª", "ǅ", "漢", "x²"]
    rows = spark.createDataFrame(
        [(1000 + i, t, k) for i, (k, t) in enumerate(corpus(10))] + [(i, t, None) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in identify(rows, F.col("doc_id") >= 1000).collect()}
    assert [found[i] == "und" for i in range(len(texts))] == [True] * 5 + [False] * 4


def test_fit_of_many_languages_is_sparse():
    import tracemalloc

    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts, names = [], []
    for k in range(40):
        own = rng.dirichlet(np.full(26, 0.3))
        for _ in range(100):
            texts.append("".join(rng.choice(letters, 200, p=own)))
            names.append(f"l{k:02}")
    tracemalloc.start()
    model = fit(texts, names)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and len(model.languages) == 40
    found, _ = model.predict(texts[::7])
    assert np.mean([a == b for a, b in zip(found, names[::7])]) > 0.9


def test_text_over_several_spans(monkeypatch):
    """n-grams that reach over the end of a span are counted too."""
    from stormgrid.llm import language_id

    data = np.frombuffer(b"the quick brown fox jumps over the lazy dog" * 5, np.uint8)
    whole = np.unique(np.concatenate(list(gram_slots(data))))
    monkeypatch.setattr(language_id, "SPAN", 16)
    assert np.unique(np.concatenate(list(gram_slots(data)))).tolist() == whole.tolist()


def test_ridge_solution_against_a_dense_one():
    """Scores of the fitted model equal one-versus-rest ridge regression on the kernel's features, row by row."""
    rows = corpus(12)
    texts, names = [t for _, t in rows], [k for k, _ in rows]
    model = fit(texts, names, grams=64, landmarks=10)
    x = model.presence(texts)
    marks = x @ model.landmarks
    own = marks[[i for _, i in sorted((names[:i].count(k), i) for i, k in enumerate(names))[:10]]]
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    keep = values > 1e-6 * values[-1]
    features = marks.astype(np.float64) @ (vectors[:, keep] / np.sqrt(values[keep]))
    found = []
    for k in model.languages:
        target = np.array([1.0 if n == k else -1.0 for n in names])
        weight = np.array([len(names) / len(model.languages) / names.count(n) for n in names])
        gram, right = np.zeros((features.shape[1],) * 2), np.zeros(features.shape[1])
        for row, t, w in zip(features, target, weight):
            gram += w * np.outer(row, row)
            right += w * t * row
        found.append(features @ np.linalg.solve(gram + 1e-2 * len(names) * np.eye(len(gram)) / len(gram), right))
    best = np.argmax(np.array(found), axis=0)
    assert [model.languages[i] for i in best] == model.predict(texts)[0]
