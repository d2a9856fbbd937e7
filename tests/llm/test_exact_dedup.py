import hashlib
import re

from pyspark.sql import functions as F

from stormgrid.llm import exact_dedup
from stormgrid.llm.exact_dedup import drop_copies, exact_groups


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_against_brute_force(awkward):
    rows = awkward.collect()
    groups = {}
    for r in rows:
        groups.setdefault(norm(r["text"]), []).append(r["doc_id"])
    found = exact_groups(awkward).collect()
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = {}
    for r in found:
        ids = by_digest[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == (min(known) if known else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept[r["text_sha256"]] = kept.get(r["text_sha256"], 0) + 1
    assert kept == dict.fromkeys(by_digest, 1)


def test_rows_that_stay_keep_all_columns(awkward):
    out = drop_copies(awkward)
    assert out.columns == awkward.columns
    texts = [norm(r["text"]) for r in out.collect()]
    assert sorted(texts) == sorted({norm(r["text"]) for r in awkward.collect()})


def test_hot_content_is_cut_in_pieces(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'copy' else cast(id as string) end as text")
    found = exact_groups(rows)
    copies = found.filter("group_size > 1")
    assert (copies.count(), copies.filter("kept").count()) == (1334, 1)
    assert copies.select("keep_id").distinct().collect()[0][0] == 0
    assert found.count() == 4000


def test_only_large_groups_are_cut(spark, monkeypatch):
    held = []
    keep = exact_dedup.materialize
    monkeypatch.setattr(exact_dedup, "materialize", lambda df: held.append(keep(df)) or held[-1])
    rows = spark.range(4000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'copy' else concat('pair ', id div 6) end as text")
    found = exact_groups(rows)
    pieces = held[0].groupBy("text_sha256").agg(F.count_distinct("salt").alias("pieces"), F.count("*").alias("n")).collect()
    assert [p["n"] for p in pieces if p["pieces"] > 1] == [1334]  # all others lie side by side
    assert {r[0] for r in found.filter("group_size < 1000").select("group_size").distinct().collect()} == {2, 4}
    assert found.count() == 4000 and found.filter("kept").count() == len(pieces)


def test_main_path_is_native(awkward):
    text = exact_groups(awkward)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_empty_table(nothing):
    assert exact_groups(nothing).count() == 0
    assert drop_copies(nothing).columns == nothing.columns
