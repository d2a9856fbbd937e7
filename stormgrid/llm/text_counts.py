"""Counts over the words and lines of one text, shared by the quality operators."""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
WINDOW = 8
_STEP = 0x9E3779B97F4A7C15


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = codes[:n].copy()
    for k in range(1, window):
        rolled *= np.uint64(_STEP)
        rolled ^= rolled >> np.uint64(29)
        rolled += codes[k:k + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def basic_counts(text: str) -> tuple[list[bytes], tuple[int, int, int, int, int]]:
    """The words, and (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # on bytes: ASCII white space only
    lines = [line for line in data.split(b"\n") if line.strip()]
    return words, (
        len(words),
        len(text) - len(data) + sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


#: Classes of characters, in this order.
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other punctuation", "beyond ASCII")
_CLASS = np.full(256, 6, np.int64)
_CLASS[128:] = 7
_CLASS[[*b"abcdefghijklmnopqrstuvwxyz"]] = 0
_CLASS[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_CLASS[[*b"0123456789"]] = 2
_CLASS[[*b" \t\n\r\x0b\x0c"]] = 3
_CLASS[[*b".,;:?'\"()-"]] = 4
_CLASS[[*SYMBOLS.encode()]] = 5
_CLASS[128 + 0:192] = 8  # second and later bytes of a character


def class_counts(text: str) -> np.ndarray:
    """Code points of each class."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by_byte = np.bincount(data, minlength=256)
    return np.bincount(_CLASS, weights=by_byte, minlength=9)[:8].astype(np.int64)
