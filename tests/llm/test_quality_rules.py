import math
import random
import re

import pytest

from stormgrid.llm.quality_rules import histograms, js_distance, judge
from stormgrid.llm.text_counts import CLASSES, class_counts, repeated_words


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def test_base_counts(spark, awkward):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in (7, 8, 9, 30, 60)]
    texts += ["x\ny\nx\n\n \n \nx ", "a\x1cb c d", "w\x0bx\x0cy\rz", "\x00 \x00"]
    made = spark.createDataFrame([(1000 + i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    rows = awkward.select("doc_id", "text", "lang").union(made)
    judged = judge(rows)
    found = sorted(tuple(r) for r in judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    ).fillna(-1, ["doc_id"]).collect())
    wanted = []
    for r in rows.collect():
        b = base(r["text"] or "") if len(r["text"] or "") < 2000 else None
        if b:
            wanted.append((r["doc_id"] if r["doc_id"] is not None else -1, *b, b[0] < 20 or 100 * b[4] > 30 * b[0]))
    assert [f for f in found if f[1] < 2000] == sorted(wanted)
    assert judged.filter("base_failed and kept").count() == 0


def test_repeated_words_of_long_texts():
    words = [str(i).encode() for i in range(5000)]
    assert repeated_words(words) == 0
    assert repeated_words(words + words[:8]) == 16
    assert repeated_words([b"a"] * 9) == 9


def test_character_classes():
    assert dict(zip(CLASSES, class_counts("aB1 .#!é漢"))) == {
        "lower": 1, "upper": 1, "digit": 1, "space": 1, "stop": 1, "symbol": 1, "other punctuation": 1, "beyond ASCII": 2}


@pytest.mark.parametrize("p, q", [([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.2, 0.8], [0.7, 0.3]), ([0.0, 0.0], [0.5, 0.5])])
def test_distance(spark, p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    row = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
    from pyspark.sql import functions as F
    assert row.select(js_distance(F.col("p"), F.col("q"))).first()[0] == pytest.approx(math.sqrt((part(p) + part(q)) / 2), abs=1e-9)


def test_verdict(spark):
    rng = random.Random(4)
    common = "the of and to a in is that for on".split()
    word = lambda: rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("etaoinshr") for _ in range(5))
    good = [(i, " ".join(word() for _ in range(200)) + ".", "en" if i % 2 else None) for i in range(40)]
    symbols = [(100, " ".join(w + "$$%" for w in good[0][1].split()), "en")]
    listed = [(101, " ".join("".join(rng.choice("etaoinshr") for _ in range(6)) for _ in range(200)), "en")]
    short = [(102, " ".join("qqqqq%d" % i for i in range(25)), "en")]
    out = {r["doc_id"]: r for r in judge(spark.createDataFrame(good + symbols + listed + short, "doc_id long, text string, lang string")).collect()}
    assert all(out[i]["kept"] for i in range(40))
    assert not out[100]["kept"] and out[100]["class_distance"] > 0.3
    assert not out[101]["kept"] and out[101]["word_distance"] > 0.275
    assert out[102]["kept"] and out[102]["word_distance"] is None  # too short to be judged


def test_references_are_plain_means_whatever_the_order(spark):
    """Copies under two languages count once in each, junk not at all."""
    from stormgrid.llm.quality_rules import COMMON_WORDS, references

    rng = random.Random(6)
    word = lambda: rng.choice(COMMON_WORDS["en"]) if rng.random() < 0.5 else "".join(rng.choice("etaoinshr") for _ in range(5))
    texts = [" ".join(word() for _ in range(150)) + "." for _ in range(30)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i % 3], "fr" if i % 2 else "en") for i in range(50)]  # copies
    rows += [(200 + i, "$%& of 17 " * 200, "en") for i in range(40)]  # repeats itself: fails the base rules
    distinct = sorted({(t, k) for _, t, k in rows if "$" not in t})
    shares = [[c / sum(h) for c in h] for h in (class_counts(t).tolist() for t, k in distinct if k == "en")]
    listed = {w: i for i, w in enumerate(COMMON_WORDS["en"])}
    words = []
    for t, k in distinct:
        if k == "en":
            own = [w.strip(".,;:!?\"'()").lower() for w in t.split(" ")]
            words.append([sum(w == x for w in own) / len(own) for x in listed] + [sum(w not in listed for w in own) / len(own)])
    for seed in (1, 2):
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3 + seed)
        found = {lang: (c, w) for lang, c, w in references(histograms(frame))}
        assert found["en"][0] == pytest.approx([sum(x) / len(x) for x in zip(*shares)], abs=1e-12)
        assert found["en"][1] == pytest.approx([sum(x) / len(x) for x in zip(*words)], abs=1e-12)
        assert "fr" not in found  # too few contents


def test_unknown_language_has_no_word_histogram(spark):
    row = spark.createDataFrame([(1, "αβγ δεζ " * 60, "el")], "doc_id long, text string, lang string")
    found = histograms(row).first()
    assert found["lang"] is None and found["common"] == []
    assert judge(row).first()["word_distance"] is None


def test_empty_table(nothing):
    assert judge(nothing).count() == 0
