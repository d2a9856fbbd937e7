"""Quality rules by distribution divergence.

A document's character-class and common-word histograms are compared with the reference of its
language by Jensen-Shannon distance.  References are means over all documents of a language that
pass the base rules, each distinct content counting once, so neither junk, long texts nor copies
outweigh others.  Texts below a
minimum length are not judged by a histogram, since short samples diverge by chance.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stormgrid.llm.text_counts import basic_counts, class_counts
from stormgrid.llm.texts import slices, strings
from stormgrid.session import materialize

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is that for on with as it be this by are was not or from at but an have".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas plus ce il ne se avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es lo como más pero sus".split(),
}
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.275
MIN_CHARS = 200
MIN_WORDS = 100
MIN_REFERENCE_DOCS = 20


def histograms(
    df: DataFrame, common_words: Mapping[str, Sequence[str]] = COMMON_WORDS, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(id, lang, content, n_words, ..., n_repeat_words, classes, common) of every row.

    ``lang`` is the row's own if it has a word list, else the list that covers most of the text
    (at least a tenth of its words), else null.  ``common`` counts the words of that list, in
    order, then all others.
    """
    kind = to_arrow_type(df.schema[id_col].dataType)
    lists = {lang: {w.encode(): i for i, w in enumerate(words)} for lang, words in common_words.items()}

    def one(text: str, lang: str | None) -> tuple:
        words, counts = basic_counts(text)
        lower = [w.strip(b".,;:!?\"'()").lower() for w in words]
        if lang not in lists:
            hits = {k: sum(w in found for w in lower) for k, found in lists.items()}
            lang = max(hits, key=lambda k: (hits[k], k), default=None)
            if lang is not None and 10 * hits[lang] < max(1, len(words)):
                lang = None
        common: list[int] = []
        if lang is not None:
            found = lists[lang]
            common = [0] * (len(found) + 1)
            for i in map(found.get, lower):
                if i is not None:
                    common[i] += 1
            common[-1] = len(words) - sum(common)
        content = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
        return lang, content, *counts, class_counts(text).tolist(), common

    names = ["id", "lang", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "classes", "common"]
    kinds = [kind, pa.string(), *[pa.int64()] * 6, pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = list(map(one, strings(part.column(1)), part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds[1:])]], names
                )

    rows = df.select(
        df[id_col].alias("id"), df[text_col].cast("string").alias("text"), df[lang_col].cast("string").alias("lang")
    )
    counts = ", ".join(f"{n} bigint" for n in names[2:8])
    return rows.mapInArrow(
        run, f"id {df.schema[id_col].dataType.simpleString()}, lang string, {counts}, "
             "classes array<bigint>, common array<bigint>"
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))


def _mean_of(column: str, size: int) -> Column:
    return F.array(*[F.avg(F.col(column)[i]) for i in range(size)])


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def references(
    hists: DataFrame, common_words: Mapping[str, Sequence[str]] = COMMON_WORDS,
    min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, min_docs: int = MIN_REFERENCE_DOCS,
) -> list[tuple]:
    """(lang, class shares, word shares) of each listed language, null for all together.

    One row a listed language, so what comes to the driver is bounded by the lists.  A language of
    fewer than ``min_docs`` distinct contents has no reference.
    """
    widest = 1 + max(map(len, common_words.values()), default=0)
    long = hists.filter((F.col("word_chars") >= min_chars) & (F.col("n_words") >= min_words) & ~_base_failed())
    # Copies first: one row a content and language, so that a content held by a third of the rows is
    # one row.  All else of such rows is equal, so the references do not depend on the rows' order.
    distinct = long.groupBy("content", "lang").agg(F.first("classes").alias("classes"), F.first("common").alias("common"))
    shares = distinct.select("lang", _shares(F.col("classes")).alias("c"), _shares(F.col("common")).alias("w"))
    found = shares.rollup("lang").agg(
        F.grouping("lang").alias("all"), F.count(F.lit(1)).alias("n"), _mean_of("c", 8).alias("c"),
        F.array(*[F.avg(F.get(F.col("w"), F.lit(i))) for i in range(widest)]).alias("w"),
    ).filter(F.col("n") >= min_docs)
    out = []
    for row in found.collect():
        if row["all"]:
            out.append((None, row["c"], None))
        elif row["lang"] is not None:
            out.append((row["lang"], row["c"], [x for x in row["w"] if x is not None]))
    return out


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, 0 to 1; null if either is."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    bounded = F.sqrt(F.greatest(F.least(divergence, F.lit(1.0)), F.lit(0.0)))
    return F.when(divergence.isNotNull(), bounded)


def _literal(shares: Sequence[float] | None) -> Column:
    return F.lit(None).cast("array<double>") if shares is None else F.array(*[F.lit(float(x)) for x in shares])


def judge(
    df: DataFrame, common_words: Mapping[str, Sequence[str]] = COMMON_WORDS,
    max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Counts, distances and verdict of every row.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word windows.
    ``kept``: not base_failed, and each distance that can be judged is at most its limit.  A
    distance is null, and passes, where the text is too short or no reference exists.  Null texts
    count as empty; repeated rows are judged each; other columns are left out.
    """
    hists = materialize(histograms(df, common_words, id_col, text_col, lang_col))
    refs = references(hists, common_words, min_chars, min_words)
    by_lang = {lang: (c, w) for lang, c, w in refs}
    overall = by_lang.pop(None, (None, None))[0]
    class_ref, word_ref = _literal(overall), _literal(None)
    for lang, (c, w) in by_lang.items():
        class_ref = F.when(F.col("lang") == lang, _literal(c)).otherwise(class_ref)
        word_ref = F.when(F.col("lang") == lang, _literal(w)).otherwise(word_ref)
    judged = hists.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "lang", _base_failed().alias("base_failed"),
        F.when(F.col("word_chars") >= min_chars, js_distance(_shares(F.col("classes")), class_ref)).alias("class_distance"),
        F.when(F.col("n_words") >= min_words, js_distance(_shares(F.col("common")), word_ref)).alias("word_distance"),
    )
    fits = F.coalesce(F.col("class_distance") <= max_class, F.lit(True)) & F.coalesce(
        F.col("word_distance") <= max_word, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & fits)
