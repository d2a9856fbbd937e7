"""Which tokens of two tokenizers cover the same bytes of a text, and how often pairs are linked.

A byte-level vocabulary (A) encodes a space and the text, a piece vocabulary (B) the text, to which
it adds that space.  Both only join bytes inside a stretch from a single space between two visible
characters to the next one, so a text is aligned stretch by stretch and a task remembers the
stretches it has met.  Inside a stretch the libraries' spans are coarse cuts; tokens that share a
character, or the bytes of one, are told apart by counting on their decoded bytes.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.pieces import Runs, byte_alphabet
from stormgrid.llm.texts import slices, strings, written

SPACE = "▁"
#: Stretches a worker remembers in each of two generations, and their characters.
MEMO_STRETCHES = 200_000
MEMO_CHARS = 8_000_000
#: At most so many id pairs are broadcast: those with more than one in so many of all links' pairs.
HOT_PAIRS = 200_000

#: Characters of stretches that are encoded together.
JOINED = 16_384
#: What stands behind an id: another of its side, the other side, another group, another stretch, nothing.
_SIGNS = np.array([",", "|", ";", "\n", ""], object)

_VISIBLE = r"[\p{L}\p{N}\p{P}\p{S}]"
_CUT = regex.compile(rf"(?<={_VISIBLE}) (?={_VISIBLE})")
#: In a Latin-1 text, a space that does not stand between two visible characters.
_ODD = re.compile("(?:^|[\x00-\x20\x7f-\xa0]) | (?:[\x00-\x20\x7f-\xa0]|$)")


def stretches(text: str) -> list[str]:
    """The parts of a text between single spaces that stand between visible characters."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _CUT.split(text)
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


def ends_of(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes, from its span and the bytes it decodes to.

    A span's end is a cut where the next token starts at or behind it; between such cuts, where
    tokens share a character, the bytes of the tokens are added up.
    """
    cut = ends > starts
    cut[:-1] &= starts[1:] >= ends[:-1]
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(cut, np.arange(len(cut)), -1))
    return total + np.where(last >= 0, ends[last] - total[last], 0)


class Memo:
    """Alignments of stretches by number: groups as text, four counts, pairs and their links."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.keys, self.times = Runs(np.int64), Runs(np.int64)
        self.text: list[str] = []
        self.sums = np.zeros((1 << 12, 4), np.int64)
        self.bad: set[int] = set()  # stretches whose bytes differ

    def add(self, parts: list[str], text: list[str], sums: np.ndarray, keys: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.text)
        for i, part in enumerate(parts):
            self.number[part] = first + i
        self.text += text
        while len(self.sums) < len(self.text):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[first:len(self.text)] = sums
        self.keys.add_flat(keys, sizes)
        self.times.add_flat(times, sizes)
        self.chars += sum(map(len, parts)) + sum(map(len, text))

    def move(self, parts: list[str], to: Memo) -> None:
        """Give what is known of these stretches to a younger memo."""
        at = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        first = len(to.text)
        to.bad |= {first + i for i, n in enumerate(at.tolist()) if n in self.bad} if self.bad else set()
        keys, sizes = self.keys.take(at)
        to.add(parts, [self.text[n] for n in at.tolist()], self.sums[at], keys, self.times.take(at)[0], sizes)


class Aligner:
    """Both tokenizers, and the alignments of the stretches met lately.

    Stretches are remembered in two generations: when the younger is full the older one is
    forgotten, and what is met again moves to the younger, so frequent stretches stay.
    """

    def __init__(self, byte_path: str, piece_path: str, memo: int = MEMO_STRETCHES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        stand_in = byte_alphabet()
        held = {i: bytes(stand_in[c] for c in t) for t, i in self.a.get_vocab(False).items()}
        self.a_bytes = [held.get(i, b"") for i in range(max(held) + 1)]
        self.b_bytes, self.apart = [], True
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            whole = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode("utf-8")
            self.b_bytes.append(whole)
            self.apart &= SPACE not in piece.lstrip(SPACE)  # no piece reaches over a cut
        self.n_b = len(self.b_bytes)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.shown = np.array([str(i) for i in range(max(len(self.a_bytes), self.n_b))], object)
        self.visible: dict[str, bool] = {}
        self.memo = memo
        self.now, self.before = Memo(), Memo()

    def _joins(self, part: str) -> bool:
        """Whether a stretch may stand between others: both its ends are visible characters."""
        known = self.visible
        for c in (part[0], part[-1]):
            if c not in known:
                known[c] = regex.fullmatch(_VISIBLE, c) is not None
        return known[part[0]] and known[part[-1]] and SPACE not in part

    def _tokens(self, joined: str, of_a, of_b):
        """(ids, ends in bytes) of both sides, or None where bytes differ from a space and the text."""
        data = b" " + joined.encode("utf-8")
        pieces = list(of_b.pieces)
        a_ids, b_ids = of_a.ids, [p.id for p in pieces]
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != data or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
            return None
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        spans = np.fromiter(chain.from_iterable(of_a.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        if len(data) != len(joined) + 1:  # from characters to bytes
            code = np.frombuffer((" " + joined).encode("utf-32-le"), np.uint32)
            spans = np.concatenate([[0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))])[spans]
        begins = np.array([p.begin for p in pieces], np.int64) + 1
        begins[:1] = 0
        ends = np.array([p.end for p in pieces], np.int64) + 1
        return a, ends_of(spans[:, 0], spans[:, 1], self.a_sizes[a]), b, ends_of(begins, ends, self.b_sizes[b])

    def align(self, batch: list[list[str]]):
        """Stretches joined by spaces, list by list: per list None where bytes differ, otherwise per stretch
        (groups as text, counts), and pair keys and links of all stretches in a row with their numbers."""
        joined = [" ".join(parts) for parts in batch]
        encoded = self.a.encode_batch([" " + j for j in joined], add_special_tokens=False)
        pieces = self.b.encode(joined, return_type="proto", num_threads=1)
        for parts, text, of_a, of_b in zip(batch, joined, encoded, pieces):
            found = self._tokens(text, of_a, of_b)
            yield None if found is None else self._groups(parts, *found)

    def _groups(self, parts: list[str], a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray):
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        # A stretch ends where its bytes, and the space before it, do.
        edges = np.cumsum([len(p.encode("utf-8")) + 1 for p in parts])
        of_group = np.searchsorted(edges, cuts)
        counts = np.stack([
            np.bincount(of_group, w, len(parts)).astype(np.int64) for w in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)], axis=1)
        # Both sides' ids in order of groups, A before B, each followed by what stands before the next.
        side = np.concatenate([2 * of_a, 2 * of_b + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        stretch = of_group[side // 2]
        sign = np.where(side[1:] == side[:-1], 0, np.where(side[1:] // 2 == side[:-1] // 2, 1, 2))
        sign = np.append(np.where(stretch[1:] != stretch[:-1], 3, sign), 4)
        out = np.empty(2 * len(order), object)
        out[::2] = self.shown[np.concatenate([a, b])[order]]
        out[1::2] = _SIGNS[sign]
        shown = "".join(out.tolist()).split("\n")
        # Every id of A with every id of B in its group.
        first_b = np.cumsum(n_b) - n_b
        times = n_b[of_a]
        total = np.cumsum(times)
        where = np.arange(int(total[-1])) + np.repeat(first_b[of_a] - (total - times), times)
        key = np.repeat(a, times) * self.n_b + b[where]
        of = np.repeat(of_group[of_a], times)
        order = np.lexsort((key, of))
        key, of = key[order], of[order]
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])]))
        links = np.diff(np.append(head, len(key)))
        return shown, counts, key[head], links, np.bincount(of[head], minlength=len(parts))

    def _learn(self, fresh: list[str]) -> None:
        """Align stretches not met before, many at a time where they can stand side by side."""
        batch: list[list[str]] = []
        size = JOINED
        for part in fresh:
            if not self._joins(part):
                batch.insert(0, [part])
                continue
            if size >= JOINED:
                batch.append([])
                size = 0
            batch[-1].append(part)
            size += len(part)
        for parts, found in zip(batch, self.align(batch)):
            if found is None and len(parts) > 1:
                again = [[p] for p in parts]
                for own, single in zip(again, self.align(again)):
                    self._keep(own, single)
            else:
                self._keep(parts, found)

    def _keep(self, parts: list[str], found) -> None:
        if found is None:
            self.now.bad.add(len(self.now.text))
            found = [""], np.zeros((1, 4), np.int64), *_NOTHING, np.zeros(1, np.int64)
        self.now.add(parts, *found)

    def texts(self, texts: list[str]):
        """Per text: (groups as text, '' without tokens, four counts, pair keys in order, their links)."""
        if len(self.now.number) > self.memo or self.now.chars > MEMO_CHARS:
            self.now, self.before = Memo(), self.now
        parts = [(stretches(t) if self.apart else [t]) if t else [] for t in texts]
        now, old = self.now, self.before.number
        number = now.number
        fresh = set(chain.from_iterable(parts)).difference(number)
        if again := [p for p in fresh if p in old]:
            self.before.move(again, now)
        if new := list(fresh.difference(old)):
            self._learn(new)
        for text, own in zip(texts, parts):
            at = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
            if not own or (now.bad and not now.bad.isdisjoint(at.tolist())):
                yield self._whole(text) if own else ("", np.zeros(4, np.int64), *_NOTHING)
                continue
            keys, _ = now.keys.take(at)
            times, _ = now.times.take(at)
            keys, where = np.unique(keys, return_inverse=True)
            shown = ";".join([now.text[i] for i in at.tolist()])
            yield shown, now.sums[at].sum(0), keys, np.bincount(where, times, len(keys)).astype(np.int64)

    def _whole(self, text: str):
        """A text with a stretch whose bytes differ: it has tokens only if its joined bytes agree."""
        found = next(self.align([[text]]))
        if found is None:
            return "", np.zeros(4, np.int64), *_NOTHING
        return found[0][0], found[1][0], found[2], found[3]


_NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(*key) -> Aligner:
    """The worker's aligner; what a task has learnt serves the next one."""
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _numbers(runs: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*runs, _NOTHING[0]])))


def align(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
    show: bool = False, memo: int = MEMO_STRETCHES,
) -> DataFrame:
    """Per row, as a written table: ``row``, the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups_sha256``, and ``pairs`` with how many links each has, ``times``; with ``show`` also ``groups``.

    A group is shown as ``a1,a2|b1``, groups are joined by ``;``.  A pair is ``a * vocabulary of B + b``.
    Rows whose text is null or empty, or is not the joined bytes of both encodings, have no tokens:
    zeros, no pairs, and an empty digest.  Ids may be null or repeat; every row counts for itself.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = {"id": kind, "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long",
             "groups_sha256": "string", "pairs": "array<long>", "times": "array<long>"}
    if show:
        kinds["groups"] = "string"
    names = list(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path, memo)
        for batch in batches:
            for rows in slices(batch, 128):
                found = list(aligner.texts(strings(rows.column(1))))
                counts = np.array([f[1] for f in found], np.int64).reshape(-1, 4)
                digests = [hashlib.sha256(f[0].encode()).hexdigest() if f[0] else "" for f in found]
                columns = [rows.column(0), *map(pa.array, counts.T), pa.array(digests, pa.string()),
                           _numbers([f[2] for f in found]), _numbers([f[3] for f in found])]
                if show:
                    columns.append(pa.array([f[0] for f in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, ", ".join(f"{c} {t}" for c, t in kinds.items()))
    return written(found.withColumn("row", F.monotonically_increasing_id()))


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): in how many rows a pair is linked, and whether no pair of its A id has more."""
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count")))
    a = F.floor(F.col("pair") / F.lit(n_b)).alias("a")
    # One row per A id at most: bounded by its vocabulary.
    most = counts.groupBy(a).agg(F.max("count").alias("most"))
    named = counts.withColumn("a", a).join(F.broadcast(most), "a")
    return written(named.select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def link_scores(aligned: DataFrame, n_b: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of ``align``: its counts, ``n_best`` links of best pairs and ``count_sum`` over its links.

    Pairs with more than one in ``hot_pairs`` of all rows' pairs are at most so many and are
    broadcast; the links of the others meet their counts in a shuffle, where no pair is large.
    """
    counts = pair_counts(aligned, n_b)
    total = counts.agg(F.sum("count")).first()[0] or 0
    limit = F.lit(total / hot_pairs)
    hot, rare = counts.filter(F.col("count") > limit), counts.filter(F.col("count") <= limit)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    ]
    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    none = [F.lit(None).cast(aligned.schema[c].dataType).alias(c) for c in kept]
    few = links.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
    parts = [
        joined.groupBy("row").agg(*sums).select("row", *none, "n_best", "count_sum")
        for joined in (links.join(F.broadcast(hot), "pair"), few.join(rare, "pair"))
    ]
    rows = aligned.select("row", *kept, _zero("n_best"), _zero("count_sum")).unionByName(parts[0]).unionByName(parts[1])
    return rows.groupBy("row").agg(
        *[F.max(c).alias(c) for c in kept], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    ).drop("row")


def _zero(name: str) -> Column:
    return F.lit(0).cast("long").alias(name)
