import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stormgrid.llm import queries
from tests.llm.test_language_id import corpus

FOLDER = "/root/testdata/sf0.001"


def norm(text):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def run_stages(spark, docs):
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        out[name] = docs
    return out


def test_stages_over_awkward_rows(spark, awkward):
    docs = awkward.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"), "row", "kept")
    out = run_stages(spark, docs)
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert out[name].columns == docs.columns, name
    known = [r["text"] for r in out[names[0]].collect()]
    assert all(any(c.isalpha() for c in t) for t in known) and "one" in known
    distinct = [norm(r["text"]) for r in out[names[1]].collect()]
    assert sorted(distinct) == sorted({norm(t) for t in known})
    assert out[names[3]].count() == out[names[2]].count() <= len(distinct)
    assert all(r["n_chars"] == len(r["text"]) for r in out[names[3]].collect())
    packed = out[names[4]].groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert packed and all(r["n"] % r["doc_tokens"] == 0 for r in packed)


def test_texts_in_no_known_language_go(spark):
    rng = random.Random(4)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n))
    good = [(i, t, k) for i, (k, t) in enumerate(corpus(60))] + [(1000, "the and with", None), (1001, "nicht auch", None), (1002, "one", None)]
    strange = ["Быстрая коричневая лиса перепрыгивает через ленивую собаку", "敏捷的棕色狐狸跳过了懒狗然后跑进森林里面去",
               "Szybki brązowy lis przeskakuje nad leniwym psem i ucieka do lasu", "x" * 200, letters(4), letters(40), letters(1000)]
    docs = spark.createDataFrame(good + [(2000 + i, t, None) for i, t in enumerate(strange)], "doc_id long, text string, lang string")
    left = {r["doc_id"] for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert left == {i for i, _, _ in good}


def test_stages_over_no_rows(spark, nothing):
    docs = nothing.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    for name, frame in run_stages(spark, docs).items():
        assert frame.count() == 0, name


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r[0] for r in rows.select("doc_id").distinct().collect()}
    assert ids <= {r[0] for r in documents.select("doc_id").collect()}
    first = {}
    for r in documents.orderBy("doc_id").collect():
        first.setdefault(norm(r["text"]), r["doc_id"])
    assert ids <= set(first.values()) and len(ids) > 0.9 * len(first)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_a_row_a_document(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    if name.startswith("op11"):  # five rows for every fiftieth vector
        asked = spark.read.parquet(f"{FOLDER}/embeddings.parquet").filter("vec_id % 50 = 0").count()
        assert frame.groupBy("query_id").count().filter("count = 5").count() == asked
        return
    key = "page_id" if name.startswith("op4") else "doc_id"
    source = spark.read.parquet(f"{FOLDER}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert frame.select(key).distinct().count() == source.count()
    assert name.startswith("op10") or frame.count() == source.count()
