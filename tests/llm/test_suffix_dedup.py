import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from stormgrid.llm import suffix_dedup
from stormgrid.llm.suffix_dedup import anchor_runs, cut_repeats, late_starts, two_stage_order


def brute(rows, length):
    """Removed flags of each (id, bytes) row; rows equal in both are one document."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        edge = np.zeros(len(text) + 1, int)
        for s in range(len(text) - length + 1):
            w = text[s:s + length]
            if w in seen:
                edge[s] += 1
                edge[s + length] -= 1
            seen.add(w)
        out[i, text] = np.cumsum(edge)[:-1] > 0
    return out


@pytest.mark.parametrize("seed", range(12))
def test_two_stage_order(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([b"ab", b"abcd", bytes(range(1, 250))])
    text = np.frombuffer(bytes(rng.choice(alphabet) for _ in range(300)), np.uint8).copy()
    text[[rng.randrange(300) for _ in range(4)]] = 0
    text = np.concatenate([text, np.zeros(20, np.uint8)])
    wanted = (np.random.default_rng(seed).random(len(text)) < 0.5) & (text > 0)
    order = two_stage_order(text, wanted, 20)
    held = text.tobytes()
    keys = [held[i:i + 16].split(b"\0")[0] for i in order]
    assert sorted(order) == np.flatnonzero(wanted).tolist() and keys == sorted(keys)


def test_late_starts():
    data = np.frombuffer(b"abcdefghij" + b"xabcdefgy" + b"abcdefghij", np.uint8)
    late, run = late_starts(data, np.array([0, 10, 19, 29]), np.array([7, 6, 7]), np.array([1, 0, 2]), np.array([0, 0, 0]), 4)
    assert late.tolist() == [True] * 4 + [False] * 3 + [False] * 6 + [True] * 7
    assert run.tolist() == [0] * 7 + [1] * 6 + [2] * 7


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(1)
    middle = rng.integers(97, 123, 400).astype(np.uint8)
    found = []
    for n in (0, 13, 777):
        text = np.concatenate([rng.integers(97, 123, n).astype(np.uint8), middle])
        keys, low, count = anchor_runs(text)
        assert count.sum() == len(text) - 99 and low[0] == 0
        of = np.repeat(keys, count)
        found.append(of[n:].tolist())
    assert found[0] == found[1] == found[2]
    assert [len(x) for x in anchor_runs(middle[:99])] == [0, 0, 0]


@pytest.mark.parametrize("hot_runs", [256, 2])
def test_against_brute_force(spark, awkward, hot_runs):
    rng = random.Random(hot_runs)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(3)]
    line = "released under terms that are in very many of these"  # one anchor, many surroundings
    made = [(100 + i, "".join(rng.choice("xyz é\n") for _ in range(rng.randrange(200))) + rng.choice(passages)
             + "".join(rng.choice("uvw") for _ in range(60)) + line + "".join(rng.choice("uvw") for _ in range(60)))
            for i in range(40)]
    made += [(200, "z" * 400), (201, "z" * 90), (202, passages[0] * 3)]
    own = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] not in (None, 20)]
    rows = spark.createDataFrame(made + own, "doc_id long, text string").repartition(4)
    wanted = brute([(i, (t or "").encode()) for i, t in made + own], 100)
    found = cut_repeats(rows, hot_runs=hot_runs).collect()
    assert len(found) == len(made) + len(own)
    texts = {}
    for i, t in made + own:
        texts.setdefault(i, (t or "").encode())
    for r in found:
        text = texts[r["doc_id"]]
        gone = np.zeros(len(text), bool)
        for s in r["removed"]:
            gone[s["start"]:s["end"]] = True
        assert gone.tolist() == wanted[r["doc_id"], text].tolist(), r["doc_id"]
        assert bytes(r["kept"]) == np.frombuffer(text, np.uint8)[~gone].tobytes()
        assert r["n_bytes"] == len(text) and all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_frequent_string_is_no_large_group(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(140))
    around = lambda: "".join(rng.choice("uvwxyz") for _ in range(110))
    made = [(i, around() + passage + around()) for i in range(1200)]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(12, "doc_id")
    documents = suffix_dedup._documents(docs, "doc_id", "text", True)
    met = suffix_dedup._met(suffix_dedup._listed(documents, 100)).filter(F.col("kind") < suffix_dedup.KIND_LATE)
    rows = suffix_dedup._with_bytes(documents, met.drop("kind"), 100, 256)
    rows = rows[0] if isinstance(rows, tuple) else rows
    groups = rows.filter(F.col("bytes").isNotNull()).groupBy("key").count().agg(F.max("count")).first()[0]
    assert groups <= 64  # not one row a document
    wanted = brute([(i, t.encode()) for i, t in made], 100)
    found = {r["doc_id"]: r["removed"] for r in cut_repeats(docs).collect()}
    for i, t in made:
        gone = np.zeros(len(t), bool)
        for s in found[i]:
            gone[s["start"]:s["end"]] = True
        assert gone.tolist() == wanted[i, t.encode()].tolist(), i


def test_held_single_strings_are_judged_on_the_way(spark):
    made = [(7, (i * 37) % 4001, 0, 5, 1, b"q" * 100, True) for i in range(4001)] + [(7, 1, 0, 5, 1, b"q" * 100, True)]
    made += [(8, i, 0, 3, 1, bytes([97 + i % 3]) * 100, True) for i in range(9)] + [(9, 50, 0, 0, 4, None, True)]
    rows = spark.createDataFrame(made, "key long, id long, hash long, low long, count long, bytes binary, single boolean")
    out = suffix_dedup._late(rows, 100, 4096).collect()
    assert sorted((r["id"], bytes(r["bytes"])[:1]) for r in out if r["bytes"] is not None and r["low"] == 3) == [
        (0, b"a"), (1, b"b"), (2, b"c")]
    assert {r["id"] for r in out if r["bytes"] is not None and r["low"] == 5} == {0}
    late = [(r["id"], r["low"], r["count"]) for r in out if r["bytes"] is None]
    assert set(late) == {(i, 5, 1) for i in range(1, 4001)} | {(i, 3, 1) for i in range(3, 9)} | {(50, 0, 4)}


def test_null_and_repeated_ids(awkward):
    found = cut_repeats(awkward, carry=True)
    assert set(found.columns) == {"doc_id", "n_bytes", "removed", "kept", "text", "row"}
    rows = found.collect()
    assert len(rows) == awkward.count()
    shared = [r for r in rows if r["doc_id"] is None and r["n_bytes"]]
    assert shared[0]["kept"] == b"" and shared[0]["text"] == ""  # nulls come last, so their copy goes


def test_empty_table(nothing):
    assert cut_repeats(nothing).count() == 0


def test_anchors_of_a_text_over_several_spans(monkeypatch):
    """A start has the same anchor wherever the text is cut into spans."""
    rng = np.random.default_rng(8)
    data = rng.integers(97, 101, 5000).astype(np.uint8)

    def by_start(span):
        monkeypatch.setattr(suffix_dedup, "SPAN", span)
        key, low, count = suffix_dedup.anchor_runs(data)
        assert low.tolist() == sorted(low.tolist()) and int(count.sum()) == len(data) - 99
        assert (low[1:] == low[:-1] + count[:-1]).all()
        return np.repeat(key, count).tolist()

    whole = by_start(1 << 22)
    assert by_start(300) == whole and by_start(1777) == whole


@pytest.mark.parametrize("n", [1, 40])
def test_block_of_runs_needs_bounded_memory(n):
    """Judging a block takes at most some 80 times its bytes."""
    import tracemalloc

    rng = np.random.default_rng(9)
    size = 1 << 18
    data = rng.integers(97, 123, size).astype(np.uint8)
    cuts = np.linspace(0, size, n + 1).astype(np.int64)
    starts = np.diff(cuts) - 99
    tracemalloc.start()
    late, _ = suffix_dedup.late_starts(data, cuts, starts, np.arange(n), np.zeros(n, np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not late.any() and peak < 160 * size
