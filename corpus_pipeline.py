"""From raw documents to packed training sequences.

Each stage takes all rows the one before kept and, but for the last, gives back rows with the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid.llm.exact_dedup import drop_copies
from stormgrid.llm.language_id import UNDETERMINED, identify
from stormgrid.llm.packing import pack
from stormgrid.llm.queries import BYTE_BPE, remainder
from stormgrid.llm.simhash import drop_near_copies
from stormgrid.llm.suffix_dedup import cut_repeats
from stormgrid.llm.texts import ship_package, table, written

#: Documents with a smaller share of n-grams of their language are in none of the known ones.  On
#: sf0.01 held-out documents have above 0.85, pieces of four words of them 0.8 and more; other
#: languages and random letters have 0.5 and less.
MIN_KNOWN_GRAMS = 0.6


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, without text or in no known language go."""
    ship_package(spark)
    found = identify(docs, remainder(5) != 0, carry=True)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("known") >= MIN_KNOWN_GRAMS))
    return kept.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return drop_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of close fingerprints the document with the smallest id stays."""
    ship_package(spark)
    return drop_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred earlier are cut out of the texts; every document stays."""
    ship_package(spark)
    cut = cut_repeats(docs, carry=True)
    columns = [
        F.col("text") if c == "text"
        else F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return cut.select(*columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 tokens, with their ids."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path(BYTE_BPE)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: No SQL: language ID, fingerprints, byte strings and token ids are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
