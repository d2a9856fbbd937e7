"""Leaves, roots, proofs and folding against a plain tree built in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stormgrid.llm import merkle
from stormgrid.llm.merkle import _trees, fold, manifest, nodes_of, path_hash, ranked, record_hash

FIELDS = ["doc_id", "lang", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def record(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root, and per leaf its siblings from the bottom: (left, digest) or None."""
    paths, cover, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        upper, covered = [], []
        for i in range(0, len(level), 2):
            run = level[i:i + 2]
            for j in range(len(run)):
                for leaf in cover[i + j]:
                    paths[leaf].append((j == 1, run[1 - j]) if len(run) == 2 else None)
            upper.append(sha("".join(run)))
            covered.append(sum(cover[i:i + 2], []))
        level, cover = upper, covered
    return level[0], paths


def brute(rows):
    """(id, leaf, subroot, root, proof, path) of rows (id, lang, text)."""
    groups = {}
    for i, lang, text in rows:
        groups.setdefault(lang, []).append((i is not None, i or 0, record(i, lang, text), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {g: tree([r[2] for r in sorted(groups[g])]) for g in names}
    root, over = tree([found[g][0] for g in names])
    return [
        (i, leaf, found[g][0], root, sha("".join(s[1] for s in path + top if s)), path + top)
        for g, top in zip(names, over) for (_, _, leaf, i), path in zip(sorted(groups[g]), found[g][1])
    ]


def result(docs):
    leaf = record_hash([F.col(c) for c in FIELDS])
    found = manifest(docs, "lang", "doc_id", leaf, {"doc_id": F.col("doc_id")})
    rows = found.withColumn("back", fold(F.col("leaf"), F.col("path"))).withColumn("proof", path_hash(F.col("path"))).collect()
    assert all(r["back"] == r["root"] for r in rows)
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"],
             [(s["left"], s["digest"]) if s["digest"] else None for s in r["path"]]) for r in rows]


def same(docs):
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(result(docs), key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("band", [2, 8])
def test_awkward_rows(awkward, monkeypatch, band):
    """Nulls as text, id and group, repeated rows, long texts, columns named like results."""
    monkeypatch.setattr(merkle, "BAND", band)
    same(awkward)


@pytest.mark.parametrize("n", [2, 9, 64, 65])
def test_sizes_over_bands(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "BAND", 2)
    rows = [(i, "big", f"t{i}") for i in range(n)] + [(100 + i, f"l{i % 3}", None) for i in range(4)]
    same(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3))


def test_many_groups_and_one_hot(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 3)
    rows = [(i, "hot" if i % 2 else f"g{i}", "x") for i in range(300)]
    same(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5))


def test_one_row_is_its_own_root(spark):
    found = result(spark.createDataFrame([(5, "en", "x")], "doc_id long, lang string, text string"))
    leaf = record(5, "en", "x")
    assert found == [(5, leaf, leaf, leaf, sha(""), [])]


def test_empty_table(nothing):
    assert result(nothing) == []


def test_groups_ascend_bytewise_null_first(spark):
    rows = [(1, "b", ""), (2, None, ""), (3, "Z", ""), (4, "é", ""), (5, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    subroots = [record(*r) for r in ((2, None, ""), (5, "", ""), (3, "Z", ""), (1, "b", ""), (4, "é", ""))]
    assert {r[3] for r in result(docs)} == {tree(subroots)[0]}


def test_changed_row_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, "en", str(i)) for i in range(20)], "doc_id long, lang string, text string")
    leaf = record_hash([F.col(c) for c in FIELDS])
    other = F.when(F.col("doc_id") % 3 == 0, record_hash([F.col("doc_id"), F.col("lang"), F.lit("changed")]))
    found = manifest(docs, "lang", "doc_id", leaf, {"doc_id": F.col("doc_id"), "other": other})
    rows = found.select("doc_id", (fold(F.coalesce("other", "leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] == (r["doc_id"] % 3 != 0) for r in rows)


def test_ranks_over_partitions(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("tree"), F.lit(1).alias("same"))
    got = ranked(rows.repartition(7), "tree", ["id"]).collect()
    for t in "012":
        own = sorted((r["id"], r["rank"]) for r in got if r["tree"] == t)
        assert [r for _, r in own] == list(range(len(own)))


def test_nodes_carry_nested_intervals(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 2)
    leaves = spark.range(21).select(
        F.lit("a").alias("tree"), F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    bands, roots = _trees(leaves)
    nodes = {}
    for r in nodes_of(bands).collect():
        nodes.setdefault(r["level"], []).append((r["lo"], r["hi"], r["digest"]))
    assert len(nodes) == 6 and [x[:2] for x in nodes[5]] == [(0, 21)]
    for level in range(1, 6):
        below = sorted(nodes[level - 1])
        for lo, hi, digest in nodes[level]:
            inside = [x for x in below if lo <= x[0] and x[1] <= hi]
            assert [inside[0][0], inside[-1][1]] == [lo, hi] and digest == sha("".join(x[2] for x in inside))
    assert roots.first()["digest"] == nodes[5][0][2]


def test_crc_rule_of_the_query_matches_zlib(spark):
    ids = spark.range(200).select(F.crc32(F.col("id").cast("string").cast("binary")).alias("c"), "id")
    assert all(r["c"] == zlib.crc32(str(r["id"]).encode()) for r in ids.collect())
