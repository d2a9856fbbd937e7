"""Splitting text into the pieces inside which byte pairs merge, and memos over pieces."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import regex

SPECIAL = "<|endoftext|>"

# The splitting pattern of the public byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: The same pattern for texts of code points below 256, where letters, digits and white space
#: are short lists; about three times as fast.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
_LATIN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_ANY = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
#: Blocks whose characters have had the same classes for many versions of Unicode.  Other
#: characters are split by the library's own splitter, since its version may be another.
_SETTLED = re.compile(
    "[\x00-\u052f\u0531-\u0556\u0561-\u0586\u2000-\u206e\u20a0-\u20b5\u2100-\u214f\u2190-\u21ff"
    "\u2200-\u22ff\u3041-\u3096\u3099-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f5ff\U0001f600-\U0001f64f]*"
)
_RUN_LATIN = re.compile(rf"[{_S}]{{2,}}(?=[^{_S}])")
_RUN_ANY = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})")


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def split(text: str) -> list[str]:
    """Pieces of a text in order; the special string is a piece of its own wherever it stands."""
    if SPECIAL in text:
        first, *rest = text.split(SPECIAL)
        out = split(first)
        for part in rest:
            out.append(SPECIAL)
            out += split(part)
        return out
    if _latin(text):
        return _LATIN.findall(text)
    return _ANY.findall(text) if _SETTLED.fullmatch(text) else _by_library(text)


@functools.cache
def _splitter():
    from tokenizers.pre_tokenizers import ByteLevel

    return ByteLevel(add_prefix_space=False, use_regex=True), byte_alphabet()


def _by_library(text: str) -> list[str]:
    library, stand_in = _splitter()
    return [bytes(stand_in[c] for c in piece).decode("utf-8") for piece, _ in library.pre_tokenize_str(text)]


def white_runs(text: str):
    """Runs of two or more white spaces before other text: the split takes off their last one."""
    return (_RUN_LATIN if _latin(text) else _RUN_ANY).finditer(text)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: printable Latin-1 is itself, the rest follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in own}
    others = [b for b in range(256) if chr(b) not in out]
    return out | {chr(256 + i): b for i, b in enumerate(others)}


class Endings:
    """Tokens by their last symbols: a trie read backwards from an end."""

    def __init__(self, tokens: dict):
        self.next: list[dict] = [{}]
        self.token = [-1]
        for token, number in tokens.items():
            node = 0
            for symbol in reversed(token):
                below = self.next[node]
                node = below.get(symbol)
                if node is None:
                    node = below[symbol] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
            self.token[node] = number

    def at(self, text, end: int) -> list[tuple[int, int]]:
        """(start, token) of the tokens of the text that end there, the shortest first."""
        found, node, i = [], 0, end - 1
        following, tokens = self.next, self.token
        while i >= 0:
            node = following[node].get(text[i])
            if node is None:
                break
            if tokens[node] >= 0:
                found.append((i, tokens[node]))
            i -= 1
        return found


class BytePairs:
    """Vocabulary and merge order of a byte-level model file, and the rule which tokens may meet."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        stand_in = byte_alphabet()

        def plain(token: str) -> bytes | None:
            return bytes(stand_in[c] for c in token) if all(c in stand_in for c in token) else None

        self.ids = {b: i for t, i in model["vocab"].items() if (b := plain(t)) is not None}
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(plain(a), plain(b)): r for r, (a, b) in enumerate(merges)}
        self.bytes_of = {i: token for token, i in self.ids.items()}
        self.bytes_of[-1] = b""
        self.endings = Endings(self.ids)
        self._meet: dict[int, bool] = {}

    def merged(self, text: bytes) -> list[bytes]:
        """Merge by rank, one pair at a time; only for texts of two tokens."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            found = [(self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))]
            best = min(found)[0]
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.rank.get((parts[i], parts[i + 1])) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def meets(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side are what their joint text is encoded to; -1: none."""
        known = self._meet.get(left << 32 | right)
        if known is None:
            if len(self._meet) > 1_000_000:
                self._meet.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self._meet[left << 32 | right] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def prefix_tokens(self, pieces: list[bytes]) -> dict[bytes, list[int]]:
        """Token counts of all byte prefixes, the empty one first, of each piece.

        The encoding of a prefix ends in the one token that ends there and may follow the last
        token of the prefix before it; so each prefix takes a look at the tokens ending there.
        Pieces are gone through in order, and what two have in common is counted once.
        """
        at, known, meets = self.endings.at, self._meet, self.meets
        out = {}
        count, last, before = [0], [-1], b""
        for piece in sorted(pieces):
            same, most = 0, min(len(piece), len(before))
            while same < most and piece[same] == before[same]:
                same += 1
            count, last = count[:same + 1], last[:same + 1]
            for end in range(same + 1, len(piece) + 1):
                for start, token in reversed(at(piece, end)):
                    left = last[start]
                    meet = known.get(left << 32 | token)
                    if meet or (meet is None and meets(left, token)):
                        count.append(count[start] + 1)
                        last.append(token)
                        break
            out[piece], before = count, piece
        return out


class Numbered(dict):
    """Piece -> number, given out in order of appearance; new pieces wait in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.fresh.append(piece)
        return n


class Lookup:
    """Numbers from 0 by 64-bit keys, looked up many at a time."""

    FREE = np.iinfo(np.int64).min
    _SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys=(), values=()):
        self.n = 0
        self._room(1 << 16)
        self.add(np.asarray(keys, np.int64), np.asarray(values, np.int32))

    def _room(self, size: int) -> None:
        self.keys, self.values = np.full(size, self.FREE), np.zeros(size, np.int32)
        self._shift = np.uint64(65 - size.bit_length())

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * self._SPREAD >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those without one."""
        at = self._place(keys)
        held = self.keys[at]
        same = held == keys
        out = np.where(same, self.values[at], np.int32(-1))
        rest = np.flatnonzero(~same & (held != self.FREE))
        while len(rest):
            at[rest] = here = (at[rest] + 1) & (len(self.keys) - 1)
            held = self.keys[here]
            same = held == keys[rest]
            out[rest[same]] = self.values[here[same]]
            rest = rest[~same & (held != self.FREE)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different keys that have no number yet."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            used = self.keys != self.FREE
            keys, values = np.concatenate([self.keys[used], keys]), np.concatenate([self.values[used], values])
            self.n = 0
            self._room(1 << (4 * len(keys)).bit_length())
        self.n += len(keys)
        at = self._place(keys)
        while len(keys):
            free = self.keys[at] == self.FREE
            self.keys[at[free]] = keys[free]  # of keys for one place the last stays
            own = self.keys[at] == keys
            self.values[at[own]] = values[own]
            keys, values, at = keys[~own], values[~own], (at[~own] + 1) & (len(self.keys) - 1)


class Runs:
    """Growing store of one number run per piece."""

    def __init__(self, dtype):
        self.values = np.zeros(1 << 16, dtype)
        self.ends = np.zeros(1 << 12, np.int64)
        self.n = 0

    def add(self, runs: list) -> None:
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        kind = self.values.dtype
        arrays = [r if isinstance(r, np.ndarray) else np.asarray(r, kind) for r in runs]
        self.add_flat(np.concatenate(arrays).astype(kind, copy=False) if runs else self.values[:0], sizes)

    def add_flat(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Runs given in a row."""
        at = int(self.ends[self.n - 1]) if self.n else 0
        ends = at + np.cumsum(sizes)
        while len(self.values) < (int(ends[-1]) if len(ends) else 0):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while len(self.ends) < self.n + len(sizes):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        if len(ends):
            self.values[at:int(ends[-1])] = values
            self.ends[self.n:self.n + len(sizes)] = ends
        self.n += len(sizes)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of these pieces in a row, and their sizes."""
        ends = self.ends[numbers]
        starts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        sizes = ends - starts
        total = np.cumsum(sizes)
        at = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - sizes), sizes)
        return self.values[at], sizes
