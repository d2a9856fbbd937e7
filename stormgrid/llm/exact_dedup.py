"""Exact duplicates by sorting contents.

Normalised texts are range-partitioned on sampled splitters and sorted inside the partitions, so
that equal texts lie side by side; full comparison of neighbours then delimits the groups.  A
splitter is a text's first characters and the head of its digest, so what is sampled is small
however long texts are, and texts of one beginning are still kept apart.
A group can hold any share of the rows.  Rows are counted per splitter first, and where a splitter
has more than an average partition the sort key ends in a salt: as many salts as there are shuffle
partitions, hence no piece of a group is larger than that.  Only pieces of such a group are joined
by the SHA-256 digest of their content, one row a piece; all other groups are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid.session import materialize


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the smallest id is kept; null ids come last, and among
    repeated ids one row is kept.  An empty table gives an empty result; empty and null texts form
    one group.  Other columns are left out.
    """
    return _groups(df, df[id_col], df[text_col], F.lit(0)).drop("tie").withColumnRenamed("id", id_col)


def _groups(df: DataFrame, row_id: Column, text: Column, tie: Column) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    norm = normalised(text)
    digest = F.sha2(norm, 256)
    mark = F.concat(F.substring(norm, 1, 16), F.substring(digest, 1, 16))
    # Fewer than ``parts`` marks can have more rows than an average partition.
    hot = F.broadcast(df.select(mark.alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > max(1, df.count() // parts)).select("mark", F.lit(True).alias("hot")))
    rows = df.select(
        row_id.alias("id"), tie.cast("long").alias("tie"), norm.alias("norm"), digest.alias("text_sha256"), mark.alias("mark"),
        F.pmod(F.when(row_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(row_id)), F.lit(parts))
        .cast("int").alias("dealt"),
    ).join(hot, "mark", "left").withColumn("salt", F.when(F.col("hot"), F.col("dealt")).otherwise(-1))
    ordered = (F.col("id").asc_nulls_last(), "tie")
    piece = Window.partitionBy("mark", "salt", "norm")
    cut = rows.repartitionByRange("mark", "salt").sortWithinPartitions("mark", "salt", "norm")
    pieces = materialize(cut.select(
        "id", "tie", "salt", "text_sha256",
        F.min("id").over(piece).alias("least"), F.count(F.lit(1)).over(piece).alias("n"),
        F.row_number().over(piece.orderBy(*ordered)).alias("nth"),
    ))
    whole = pieces.filter("salt < 0").select(
        "id", "tie", F.col("least").alias("keep_id"), F.col("n").alias("group_size"), (F.col("nth") == 1).alias("kept"),
        "text_sha256")
    salted = pieces.filter("salt >= 0")
    content = Window.partitionBy("text_sha256")
    of_piece = salted.filter("nth = 1").select(
        "text_sha256", "salt", F.min("least").over(content).alias("keep_id"),
        F.sum("n").over(content).alias("group_size"),
        (F.row_number().over(content.orderBy(*ordered, "salt")) == 1).alias("leads"),
    )
    return whole.union(salted.join(of_piece, ["text_sha256", "salt"]).select(
        "id", "tie", "keep_id", "group_size", (F.col("leads") & (F.col("nth") == 1)).alias("kept"), "text_sha256"
    ))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; rows equal in every column are one row.

    Columns may have any names and any types that can be hashed.
    """
    key = F.xxhash64(*[df[c] for c in df.columns])
    kept = _groups(df, df[id_col], df[text_col], key).filter("kept").select("id", "tie")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[id_col].alias("id"), key.alias("tie"))
    met = rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["tie"] == kept["tie"]), "left_semi")
    return met.dropDuplicates(["id", "tie"]).select("row.*")
