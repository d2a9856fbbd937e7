"""Conversions that give null instead of failing (ANSI mode stays on)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormgrid import defaults as D

# Java's number parser also takes "1.5d" and "0x1p3"; such texts hold one of these letters.
_ODD_NUMBER = "[dDfFxXpP]"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a number, and NaN, becomes null."""
    text = c.cast("string")
    value = text.try_cast("double")
    missing = F.lit(None).cast("double")
    return F.when(~text.rlike(_ODD_NUMBER), F.nanvl(value, missing)).when(
        text.rlike(_INFINITE), value
    )


def null_if_token(c: Column, tokens: Iterable[str] = D.NULL_TOKENS) -> Column:
    """Text with every missing-value word replaced by null."""
    return F.when(~c.isin(list(tokens)), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def parse_ymd(c: Column) -> Column:
    """``yyyyMMdd`` (text or integer) to date, bad values to null."""
    text = c.cast("string")
    return F.when(
        text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")
    )


def _shape(fmt: str) -> str | None:
    """Regex every text of a numeric date format fits; None for other formats."""
    out = "^"
    for token in re.findall(r"'[^']*'|[A-Za-z]+|.", fmt):
        if token.startswith("'"):
            out += re.escape(token[1:-1])
        elif token == "[":
            out += "(?:"
        elif token == "]":
            out += ")?"
        elif token.isalpha():
            if len(set(token)) > 1 or token[0] not in "yMdHmsS" or token in ("MMM", "MMMM"):
                return None
            fixed = token[0] != "S" and len(token) > 1
            out += rf"\d{{{len(token)}}}" if fixed else rf"\d{{1,{max(2, len(token))}}}"
        else:
            out += re.escape(token)
    return out + "$"


def parse_day(c: Column, formats: Iterable[str] = D.DAY_FORMATS) -> Column:
    """Timestamp text to its day; the first format that fits wins, else null.

    A failed parse costs an exception inside Spark, so each format is tried only
    on text of its shape, and shapes with a slash only on text with one.
    """
    text = F.trim(c.cast("string"))
    tries: dict[bool, list[Column]] = {True: [], False: []}
    for fmt in formats:
        shape, parsed = _shape(fmt), F.try_to_timestamp(text, F.lit(fmt))
        fits = parsed if shape is None else F.when(text.rlike(shape), parsed)
        maybe = "/" in "".join(re.findall(r"\[[^\]]*", fmt))  # in an optional part
        for slash in (True, False):
            if shape is None or maybe or slash == ("/" in fmt):
                tries[slash].append(fits)
    never = F.lit(None).cast("timestamp")
    with_slash, without = (F.coalesce(never, *tries[slash]) for slash in (True, False))
    return F.when(F.contains(text, F.lit("/")), with_slash).otherwise(without).cast("date")


def to_upper(c: Column) -> Column:
    return F.upper(c.cast("string"))


def to_int(c: Column) -> Column:
    """Number-like value to int (``'1.0'`` counts as 1), bad values to null."""
    return to_number(c).try_cast("int")
