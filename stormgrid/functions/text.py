"""Accent folding and key normalisation as native column expressions.

Folding means: compatibility-decompose (NFKD) and drop every combining mark.
Spark has no such function, so the mapping is tabulated once on the driver from
``unicodedata`` and handed to ``translate`` as literals.  Three tiers keep the
common case cheap: ASCII text passes through, Latin-1 text uses a 60-character
table, and only text beyond Latin-1 pays for the full Unicode table.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() and str.split() treat as white space.
SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_LAST_MAPPED = 0x30000
_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3


def _decompose(ch: str) -> str:
    kept = [p for p in unicodedata.normalize("NFKD", ch) if unicodedata.combining(p) == 0]
    return "".join(kept)


@cache
def _fold_table(first: int, last: int) -> tuple[str, str, dict[str, str]]:
    """(characters to translate, their replacements, characters that grow).

    Characters at the end of the first string without a partner in the second
    are deleted by ``translate``.
    """
    sources, targets, deleted, grown = [], [], [], {}
    for code in range(first, last):
        if 0xD800 <= code <= 0xDFFF or _HANGUL_FIRST <= code <= _HANGUL_LAST:
            continue
        ch = chr(code)
        folded = _decompose(ch)
        if folded == ch:
            continue
        if folded == "":
            deleted.append(ch)
        elif len(folded) == 1:
            sources.append(ch)
            targets.append(folded)
        else:
            grown[ch] = folded
    return "".join(sources + deleted), "".join(targets), grown


def _char_class(chars) -> str:
    """Regex class body of code-point ranges covering ``chars``."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges)


def _expand_hangul(ch: Column) -> Column:
    """A Hangul syllable as its two or three jamo (arithmetic rule of Unicode)."""
    index = F.ascii(ch) - F.lit(_HANGUL_FIRST)
    lead = F.lit("".join(map(chr, range(0x1100, 0x1113))))
    vowel = F.lit("".join(map(chr, range(0x1161, 0x1176))))
    tail = F.lit("".join(map(chr, range(0x11A8, 0x11C3))))
    t = F.pmod(index, F.lit(28))

    def pick(letters: Column, position: Column) -> Column:
        return F.substring(letters, position.cast("int"), F.lit(1))

    return F.concat(
        pick(lead, F.floor(index / 588) + 1),
        pick(vowel, F.floor(F.pmod(index, F.lit(588)) / 28) + 1),
        F.when(t > 0, pick(tail, t)).otherwise(F.lit("")),
    )


def _fold_wide(c: Column) -> Column:
    sources, targets, grown = _fold_table(0x80, _LAST_MAPPED)
    keys = "".join(grown)
    values = F.split(F.lit("\x00".join(grown.values())), "\x00")  # folded to one literal
    needs_growth = f"[{_char_class(keys)}\\x{{{_HANGUL_FIRST:X}}}-\\x{{{_HANGUL_LAST:X}}}]"

    def grow(ch: Column) -> Column:
        place = F.instr(F.lit(keys), ch)
        return (
            F.when(F.octet_length(ch) == 1, ch)
            .when(F.ascii(ch).between(_HANGUL_FIRST, _HANGUL_LAST), _expand_hangul(ch))
            .when(place > 0, F.try_element_at(values, place))
            .otherwise(ch)
        )

    grown_text = F.array_join(F.transform(F.split(c, ""), grow), "")
    return F.translate(F.when(c.rlike(needs_growth), grown_text).otherwise(c), sources, targets)


def _fold_latin(c: Column) -> Column:
    sources, targets, grown = _fold_table(0x80, 0x100)
    out = c
    for ch, text in grown.items():
        out = F.replace(out, F.lit(ch), F.lit(text))
    return F.translate(out, sources, targets)


def fold(c: Column) -> Column:
    """NFKD without combining marks; null stays null."""
    c = c.cast("string")
    return (
        F.when(F.octet_length(c) == F.char_length(c), c)
        .when(c.rlike(r"[^\x00-\xFF]"), _fold_wide(c))
        .otherwise(_fold_latin(c))
    )


def strip(c: Column) -> Column:
    """Trim all Unicode white space at both ends (``F.trim`` only cuts blanks)."""
    return F.btrim(c, F.lit(SPACES))


def normalize_key(c: Column) -> Column:
    """Join key: folded, trimmed, upper case; null stays null."""
    return F.upper(strip(fold(c)))


def normalize_text(c: Column) -> Column:
    """Label text: folded, trimmed, lower case, single blanks; null becomes ''."""
    flat = F.regexp_replace(F.lower(strip(fold(c))), f"[{_char_class(SPACES)}]+", " ")
    return F.coalesce(flat, F.lit(""))


def normalize_ascii(c: Column) -> Column:
    """Serving key: folded, non-ASCII dropped, upper case, trimmed; null becomes ''."""
    ascii_only = F.regexp_replace(fold(strip(c.cast("string"))), r"[^\x00-\x7F]", "")
    return F.coalesce(strip(F.upper(ascii_only)), F.lit(""))


def clean_column_name(name: str) -> str:
    """Trim, lower case, blanks and slashes to underscores."""
    return str(name).strip().lower().translate(str.maketrans(" /", "__"))
