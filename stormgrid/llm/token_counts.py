"""Exact token counts of every prefix of every text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stormgrid.llm.pieces import SPECIAL, BytePairs, Numbered, Runs, split, white_runs
from stormgrid.llm.texts import slices, strings

#: Distinct pieces a task remembers before it starts afresh.
MEMO_PIECES = 800_000
#: Code points of output texts per batch handed back.
OUT_CHARS = 4_000_000


class PrefixCounter:
    """Counts of all prefixes of texts; pieces seen before are looked up."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        self.pairs = BytePairs(path)
        self.memo_pieces = memo_pieces
        self._start()

    def _start(self) -> None:
        self.numbers, self.runs = Numbered(), Runs(np.int32)

    def _learn(self) -> None:
        """Counts at the code point ends of the pieces not met before, each standing alone."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        data = [p.encode("utf-8", "surrogatepass") for p in fresh]
        counts = self.pairs.prefix_tokens(data)
        runs = []
        for piece, held in zip(fresh, data):
            count = counts[held]
            if piece == SPECIAL:
                runs.append([0] * (len(SPECIAL) - 1) + [1])
            elif piece[0] == "'" and len(piece) > 2 and piece[1].isalpha():
                # A contraction is a piece of its own, its beginning is an apostrophe and a word.
                runs.append([1, 2, count[-1]])
            elif len(held) == len(piece):
                runs.append(count[1:])
            else:
                ends, at = [], 0
                for c in piece:
                    at += len(c.encode("utf-8", "surrogatepass"))
                    ends.append(count[at])
                runs.append(ends)
        self.runs.add(runs)

    def _mark(self, text: str) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Numbers of the pieces of a text without special strings, and its white runs."""
        pieces = split(text) if text else []
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        # A prefix that ends with a white run has it in one piece.
        runs = [(m.start(), m.end(), self.numbers[m.group()]) for m in white_runs(text)]
        return numbers, runs

    def _table(self, numbers: np.ndarray, white: list[tuple[int, int, int]]) -> np.ndarray:
        if not len(numbers):
            return np.zeros(0, np.int32)
        counts, sizes = self.runs.take(numbers)
        totals = counts[np.cumsum(sizes) - 1]
        out = counts + np.repeat(np.cumsum(totals) - totals, sizes).astype(np.int32)
        if white:
            starts, ends, which = (np.array(x) for x in zip(*white))
            whole = self.runs.values[self.runs.ends[which] - 1]
            # Runs do not touch, so the count before one is not changed by another.
            out[ends - 1] = np.where(starts > 0, out[starts - 1], 0) + whole
        return out

    def tables(self, texts: list[str]) -> list[np.ndarray]:
        """``tables([text])[0][i]``: tokens of the first i + 1 code points, as encoded on their own."""
        if len(self.numbers) > self.memo_pieces:
            self._start()
        marks = []
        for text in texts:
            # While a special string is not complete its characters are ordinary text.
            *others, last = text.split(SPECIAL)
            marks.append([*(self._mark(part + SPECIAL[:-1]) for part in others), self._mark(last)])
        self._learn()
        return [self._table(*own[0]) if len(own) == 1 else self._joined(text, own) for text, own in zip(texts, marks)]

    def _joined(self, text: str, marks: list) -> np.ndarray:
        out, base = [], 0
        for part, mark in zip(text.split(SPECIAL), marks):
            counts = self._table(*mark)
            out.append(base + counts)
            if mark is not marks[-1]:
                base += (int(counts[len(part) - 1]) if part else 0) + 1
                out.append(np.array([base], np.int32))
        return np.concatenate(out).astype(np.int32)

    def counts(self, text: str) -> np.ndarray:
        return self.tables([text])[0]


_COUNTERS: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    """One memo per worker process, kept over tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_counts(
    df: DataFrame, vocabulary: str, limits: Sequence[int] = (), id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_chars, n_tokens, prefix_tokens, fits) of every row.

    ``prefix_tokens`` holds, as little-endian 32-bit numbers, the exact token count of the text's
    first 1, 2, ... code points; a question about a truncated text or a budget is a look into it.
    ``fits`` answers one: the longest prefix, in code points, of at most ``limits[i]`` tokens.
    Null and empty texts have no prefix and zero tokens.  A text may have up to 500 million code
    points, which is where the table meets the size of a Spark value.  Other columns are left out.
    """
    kind = df.schema[id_col].dataType
    limits = [int(n) for n in limits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for part in slices(batch):
                at, held, ids = 0, [], part.column(0)
                chars = 0
                texts = strings(part.column(1))
                for i, (text, counts) in enumerate(zip(texts, counter.tables(texts))):
                    fits = [int(np.flatnonzero(counts <= n)[-1]) + 1 if len(counts) and counts[0] <= n else 0
                            for n in limits]
                    held.append((len(text.encode("utf-8", "surrogatepass")), len(text),
                                 int(counts[-1]) if len(counts) else 0, counts.tobytes(), fits))
                    chars += len(text)
                    if chars >= OUT_CHARS:
                        yield _rows(ids.slice(at, i + 1 - at), held)
                        at, held, chars = i + 1, [], 0
                if held:
                    yield _rows(ids.slice(at), held)

    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return rows.mapInArrow(
        run, f"id {kind.simpleString()}, n_bytes bigint, n_chars bigint, n_tokens bigint, "
             "prefix_tokens binary, fits array<bigint>"
    )


def _rows(ids: pa.Array, held: list[tuple]) -> pa.RecordBatch:
    n_bytes, n_chars, n_tokens, table, fits = zip(*held)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_bytes, pa.int64()), pa.array(n_chars, pa.int64()), pa.array(n_tokens, pa.int64()),
         pa.array(table, pa.binary()), pa.array(fits, pa.list_(pa.int64()))],
        ["id", "n_bytes", "n_chars", "n_tokens", "prefix_tokens", "fits"],
    )


def tokens_before(counts: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` code points, from a row's ``prefix_tokens``."""
    return int(np.frombuffer(counts, "<i4")[chars - 1]) if chars else 0
