"""The operators as queries over the whole driver tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from stormgrid.llm.cross_tokens import align, link_scores
from stormgrid.llm.exact_dedup import exact_groups
from stormgrid.llm.html_text import label_blocks
from stormgrid.llm.language_id import identify
from stormgrid.llm.merkle import fold, manifest, path_hash, record_hash
from stormgrid.llm.packing import pack
from stormgrid.llm.projected_ann import nearest
from stormgrid.llm.quality_gam import quality_scores
from stormgrid.llm.quality_rules import judge
from stormgrid.llm.sentence_pieces import decode, encode
from stormgrid.llm.simhash import near_groups
from stormgrid.llm.suffix_dedup import cut_repeats
from stormgrid.llm.texts import table
from stormgrid.llm.token_counts import prefix_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, by which rows are held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances to the language references and the verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and where a budget of 1,024 tokens ends."""
    counts = prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), [1024])
    return counts.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"),
        F.col("fits")[0].alias("chars_within_limit"),
    )


@query("""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
    min(doc_id) OVER (PARTITION BY t) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept,
    sha256(t) AS text_sha256
FROM texts
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts."""
    return exact_groups(table(spark, sf_dir, "documents"))


@query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    main = label_blocks(pages.select("page_id", "html", "url"), keep="url")
    chosen = F.filter("blocks", lambda b: b["probability"] >= 0.5)
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), "\n\n")
    return main.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; four of five documents may be learned from."""
    found = identify(table(spark, sf_dir, "documents"), remainder(5) != 0)
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


@query()
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document after strings of 100 bytes that occurred earlier are cut out."""
    cut = cut_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of fingerprints at most three bits apart."""
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, a checksum of their ids, and whether they decode to its text."""
    path = public_tokenizers.path(PIECE_BPE)
    documents = table(spark, sf_dir, "documents")
    parts = encode(documents, path)
    # Giant documents apart, so that neither kind is encoded twice; their parts meet as ids.
    giant = parts.filter(F.col("row").isNotNull()).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("p"))
    joined = giant.select(
        "doc_id", "row", F.lit(0).cast("long").alias("part"),
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    texts = decode(parts.filter(F.col("row").isNull()), path, keep_ids=True).union(decode(joined, path, keep_ids=True))
    return texts.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; two of three labelled documents may be learned from."""
    scores = quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)
    return scores.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 2,048 tokens."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "tier", "step_group",
    )


def _record(n_chars: Column) -> Column:
    return record_hash([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])


@query("""
WITH usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND list_contains(list_transform(embedding, lambda x: x <> 0), true)
        AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, round(score, 12) AS score
FROM pairs WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
""")
def op11_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth; cosines to twelve digits, as engines add in different orders."""
    found = nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.round("score", 12).alias("score"))


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies, and how usual each document's links are."""
    pieces = public_tokenizers.path(PIECE_BPE)
    aligned = align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), pieces)
    scores = link_scores(aligned, SentencePieceProcessor(model_file=pieces).vocab_size())
    return scores.withColumnRenamed("id", "doc_id")


def _tree_sql(name: str, base: str) -> str:
    """CTE of the levels of a tree: every two neighbours, or a last one alone, become their hash."""
    return f"""{name} AS (
    {base}
    UNION ALL
    SELECT tree, level + 1,
        list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
    FROM {name} WHERE len(nodes) > 1
)"""


def _steps_sql(place: str, level: str, nodes: str) -> str:
    """A level's sibling, by the side it stands on; N where there is none."""
    own = f"({place} >> {level})"
    other = f"xor({own}, 1)"
    return f"""CASE WHEN {other} >= len({nodes}) THEN 'N'
        WHEN {other} < {own} THEN 'L' || {nodes}[{other} + 1] ELSE 'R' || {nodes}[{other} + 1] END"""


def _record_sql(n_chars: str) -> str:
    fields = " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({fields})"


@query(f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, n_chars, {_record_sql("n_chars")} AS leaf,
        {_record_sql("(n_chars + 1)")} AS changed,
        xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
            lambda crc, byte: list_reduce(range(8),
                lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
            CAST(4294967295 AS BIGINT)), 4294967295) % 7 = 0 AS tampered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), {_tree_sql("trees", "SELECT lang AS tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang")},
subroots AS (
    SELECT tree AS lang, nodes[1] AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place
    FROM trees WHERE len(nodes) = 1
), {_tree_sql("top", "SELECT 0 AS tree, 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0")},
steps AS (
    SELECT p.place, p.lang, t.level, {_steps_sql("p.place", "t.level", "t.nodes")} AS step
    FROM placed p JOIN trees t ON p.lang IS NOT DISTINCT FROM t.tree WHERE len(t.nodes) > 1
    UNION ALL
    SELECT p.place, p.lang, 1000 + t.level, {_steps_sql("s.place", "t.level", "t.nodes")}
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, top t WHERE len(t.nodes) > 1
), paths AS (
    SELECT place, lang, list(step ORDER BY level) AS path FROM steps GROUP BY place, lang
), folded AS (
    SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
        sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s[2:]), '')) AS proof_sha256,
        list_reduce(coalesce(path, []), lambda h, s: sha256(
            CASE s[1] WHEN 'L' THEN s[2:] || h WHEN 'R' THEN h || s[2:] ELSE h END),
            CASE WHEN tampered AND n_chars IS NOT NULL THEN changed ELSE leaf END) AS folded_root
    FROM placed p LEFT JOIN paths q ON p.place = q.place AND p.lang IS NOT DISTINCT FROM q.lang
    JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
)
SELECT *, folded_root = root AS verified FROM folded
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root folded from a leaf that may be tampered with."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    changed = F.when(tampered & F.col("n_chars").isNotNull(), _record(F.col("n_chars") + 1))
    rows = manifest(
        table(spark, sf_dir, "documents"), "lang", "doc_id", _record(F.col("n_chars")),
        {"doc_id": F.col("doc_id"), "changed": changed})
    folded = rows.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", path_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
