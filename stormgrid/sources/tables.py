"""Delimited text at the edge, Parquet between stages."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid import defaults as D
from stormgrid.functions.parse import null_if_token, parse_day, to_int, to_number


def _typed(name: str, kind: T.DataType, formats: Iterable[str]):
    c = F.col(name)
    if isinstance(kind, T.DateType):
        return parse_day(c, formats)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return to_number(c).cast(kind)
    if isinstance(kind, T.IntegerType):
        return to_int(c)
    return c.try_cast(kind)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    encoding: str = "UTF-8",
    null_tokens: Iterable[str] = D.NULL_TOKENS,
    date_cols: Sequence[str] = (),
    date_formats: Iterable[str] = D.DAY_FORMATS,
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV by column name: text first, then null words, then types.

    Columns named in ``schema`` or ``date_cols`` are converted, values that do not
    fit become null, other columns stay text.  Large files are split; where quoted
    fields hold line breaks ``multi_line=True`` reads a file as one piece.
    """
    text = (
        spark.read.option("header", True).option("encoding", encoding)
        .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
        .csv(path)
    )
    tokens = list(null_tokens)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    kinds = {f.name: f.dataType for f in (schema.fields if schema else [])}
    kinds |= {c: T.DateType() for c in date_cols}
    cleaned = text.select(*[null_if_token(F.col(f"`{c}`"), tokens).alias(c) for c in text.columns])
    return cleaned.withColumns({
        c: _typed(c, kinds[c], date_formats) for c in cleaned.columns if c in kinds
    })


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    encoding: str | None = None,
) -> None:
    """Overwrite a table; CSV gets a header.

    A partitioned table is rebalanced by partition first: adaptive execution then
    writes a large partition from several tasks and does not scatter a small one
    over a file per task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
        if encoding:
            writer = writer.option("encoding", encoding)
    writer.format(fmt).save(path)


def land_batch(df: DataFrame, path: str, batch_col: str) -> None:
    """Write one batch of rows; rerunning a batch replaces only that batch."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(batch_col).parquet(path)
    )
