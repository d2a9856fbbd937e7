"""Encoding to and decoding from the pieces of a merge-type sentence-piece model.

The encoding of a text is its one chain of pieces in which every two neighbours are what the
merges make of their joint text.  So a chain is a path over piece ends, allowed steps have weight
0 less the piece it adds and others minus infinity, and text is encoded by max-plus products:

* A giant document is split into chunks.  The state at a boundary is the piece that holds the last
  character before it; a chunk's matrix has the best weight from each state at its left end to
  each at its right end.
* Matrices are multiplied in blocks, blocks in documents, and the scan is carried back down, so
  every chunk learns its true left and right state.
* Each chunk is then traced on its own between the two.

No piece has the space mark after another character, so every space mark after one is a cut with
a single state.  Between cuts the product of a chunk is that of its words, which are memorised.
Words also end between characters that no chain of pieces connects, since no merge goes over them.
New words are chained together: each step looks at one more character of all of them.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stormgrid.llm.pieces import Endings, Lookup, Numbered, Runs
from stormgrid.llm.texts import slices, strings, written

MARK = "▁"
CHUNK = 1 << 14
BLOCK = 256
#: Words remembered in each of two generations.
MEMO_WORDS = 100_000
#: Ids whose bytes are looked up at a time.
SPAN = 1 << 18
#: Pairs of pieces remembered.
PAIRS = 400_000
#: Sets of connected characters that words are told apart by; the smaller sets count as one.
SETS = 8
#: Words of at most so many characters are chained together, so many at a time.
SHORT, TOGETHER = 64, 1 << 13
NONE = -2
NORMAL, UNKNOWN, BYTE = 1, 2, 6

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """The pieces of a model file and the rule which of them may be neighbours."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto()
            model.ParseFromString(f.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave characters and spaces as they are")
        self.lead = MARK if model.normalizer_spec.add_dummy_prefix else ""
        self.ids, self.score, byte_ids = {}, {}, {}
        self.shown: list[bytes] = []
        self.unknown = 0
        for i, piece in enumerate(model.pieces):
            if piece.type == NORMAL:
                self.ids[piece.piece], self.score[piece.piece] = i, piece.score
                self.shown.append(piece.piece.replace(MARK, " ").encode())
            elif piece.type == BYTE:
                byte_ids[int(piece.piece[3:5], 16)] = i
                self.shown.append(bytes([int(piece.piece[3:5], 16)]))
            else:
                self.shown.append(" ⁇ ".encode() if piece.type == UNKNOWN else b"")
                self.unknown = i if piece.type == UNKNOWN else self.unknown
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a space mark after another character")
        self.byte_ids = byte_ids
        self.bytes = np.frombuffer(b"".join(self.shown), np.uint8)
        self.bytes_at = np.cumsum([0, *map(len, self.shown)]).astype(np.int32)
        self.longest = max(map(len, self.ids), default=1)
        # Pieces by number; characters that are no piece get numbers from the vocabulary's size on.
        self.text_of = {i: p for p, i in self.ids.items()}
        self.text_of[-1] = ""
        self.others: dict[str, int] = {}
        self.first_other = len(model.pieces)
        self._meet: dict[int, bool] = {}
        self.met = Lookup()
        self.narrow = np.dtype("<u2" if len(self.shown) <= 1 << 16 else "<i4")
        # Words met lately, and those before them: what is met again moves to the younger ones.
        self.words, self.runs = Numbered(), Runs(np.int32)
        self.old_words, self.old_runs = Numbered(), Runs(np.int32)

    # Not needed for decoding, so made at first use.
    @cached_property
    def endings(self) -> Endings:
        return Endings(self.ids)

    @cached_property
    def word(self) -> re.Pattern:
        return words_of(self.ids)

    @cached_property
    def trie(self) -> tuple[Lookup, np.ndarray]:
        """``endings`` as arrays: nodes by the node above and a character, and their tokens."""
        below = [(node << 21 | ord(c), to) for node, next_ in enumerate(self.endings.next) for c, to in next_.items()]
        return Lookup(*zip(*below)), np.array(self.endings.token, np.int32)

    @cached_property
    def single(self) -> np.ndarray:
        return np.full(0x110000, -1, np.int32)

    def merged(self, text: str) -> list[str]:
        """Merge the best pair, of equal ones the leftmost, one at a time; for two pieces only."""
        parts, none = list(text), -np.inf
        score = self.score.get
        found = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while found and (best := max(found)) > none:
            i = found.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i < len(found):
                found[i] = score(parts[i] + parts[i + 1], none)
            if i:
                found[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def number(self, piece: str) -> int:
        """The number of a piece or of a character that is none."""
        i = self.ids.get(piece)
        if i is None:
            i = self.others.get(piece)
            if i is None:
                i = self.others[piece] = self.first_other + len(self.others)
                self.text_of[i] = piece
        return i

    def meets(self, left: int, right: int) -> bool:
        """Whether two pieces, by number, may be neighbours; -1 stands for a cut."""
        known = self._meet.get(left << 32 | right)
        if known is None:
            if len(self._meet) > PAIRS:
                self._meet.clear()
            known = self._meet[left << 32 | right] = self.judged(left, right)
        return known

    def judged(self, left: int, right: int) -> bool:
        a, b = self.text_of[left], self.text_of[right]
        return self.merged(a + b) == ([a, b] if a else [b])

    def meet_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``meets`` of many pairs."""
        keys = left.astype(np.int64) << 32 | right
        known = self.met.get(keys)
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            new, at = np.unique(keys[fresh], return_inverse=True)
            judged = np.fromiter((self.judged(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()), np.int32, len(new))
            known[fresh] = judged[at]
            if self.met.n > PAIRS:
                self.met = Lookup()
            self.met.add(new, judged)
        return known > 0

    def at(self, text: str, end: int) -> list[tuple[int, int]]:
        """(start, number) of the pieces that end there, the shortest first; any character is one."""
        found = self.endings.at(text, end)
        if not found or found[0][0] != end - 1:
            found.insert(0, (end - 1, self.number(text[end - 1])))
        return found

    def ending(self, text: str, end: int) -> Iterator[str]:
        for start, _ in reversed(self.at(text, end)):
            yield text[start:end]

    def chains(self, texts: list[str]) -> dict[str, list[int]]:
        """The chain of each text between two cuts: at each end the one piece that may follow.

        Texts are gone through in order, and what two have in common is looked at once.
        """
        at, known, meets = self.at, self._meet, self.meets
        out = {}
        last, start_of, before = [-1], [0], ""
        for text in sorted(texts):
            same, most = 0, min(len(text), len(before))
            while same < most and text[same] == before[same]:
                same += 1
            last, start_of = last[:same + 1], start_of[:same + 1]
            for end in range(same + 1, len(text) + 1):
                chosen = None, 0
                for start, piece in reversed(at(text, end)):
                    left = last[start]
                    if left is None:
                        continue
                    meet = known.get(left << 32 | piece)
                    if meet or (meet is None and meets(left, piece)):
                        chosen = piece, start
                        break
                last.append(chosen[0])
                start_of.append(chosen[1])
            chain, end = [], len(text)
            while end:
                chain.append(last[end])
                end = start_of[end]
            out[text], before = chain[::-1], text
        return out

    def singles(self, codes: np.ndarray) -> np.ndarray:
        """``number`` of single characters, given as code points."""
        found = self.single[codes]
        if len(found) and found.min() < 0:
            for c in np.unique(codes[found < 0]).tolist():
                self.single[c] = self.number(chr(c))
            found = self.single[codes]
        return found

    def ends_all(self, codes: np.ndarray, row: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``at`` of many places: numbers and sizes of the pieces that end there, and how many."""
        number = np.zeros((len(row), self.longest), np.int32)
        size = np.ones((len(row), self.longest), np.int16)
        count = np.ones(len(row), np.int64)
        flat, last = codes.ravel(), row * codes.shape[1] + end - 1
        number[:, 0] = self.singles(flat[last])
        below, tokens = self.trie
        left, node = np.arange(len(row)), np.zeros(len(row), np.int64)
        for k in range(self.longest):
            node = below.get(node << 21 | flat[last[left] - k]).astype(np.int64)
            left, node = left[node >= 0], node[node >= 0]
            if k:
                token = tokens[node]
                found, token = left[token >= 0], token[token >= 0]
                number[found, count[found]], size[found, count[found]] = token, k + 1
                count[found] += 1
            more = end[left] > k + 1
            left, node = left[more], node[more]
        return number, size, count

    def chain_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the chains of different short words, sorted, in a row, and their sizes.

        As in ``chains``, but each step goes one character further in all words; beginnings a word
        has in common with the one before it are copied from there.
        """
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        width = int(sizes.max())
        codes = np.full((n, width), -1, np.int64)
        codes[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        same = np.zeros(n, np.int64)
        same[1:] = np.argmin(np.pad(codes[1:] == codes[:-1], ((0, 0), (0, 1))), axis=1)
        end, row = np.nonzero((same[:, None] <= np.arange(width)).T & (np.arange(width) < sizes[:, None]).T)
        number, size, count = self.ends_all(codes, row, end + 1)
        bounds = np.searchsorted(end, np.arange(width + 1))
        last, step = np.full((n, width + 1), NONE, np.int32), np.zeros((n, width + 1), np.int32)
        last[:, 0] = -1
        for at in range(1, width + 1):
            here = np.arange(bounds[at - 1], bounds[at])
            owner = np.zeros(n, np.int64)
            owner[row[here]] = row[here]
            which = count[here] - 1
            while len(here):
                piece, back = number[here, which], size[here, which]
                left = last[row[here], at - back]
                good = left != NONE
                good[good] = self.meet_all(left[good], piece[good])
                last[row[here[good]], at], step[row[here[good]], at] = piece[good], back[good]
                rest = ~good & (which > 0)
                here, which = here[rest], which[rest] - 1
            owner = np.maximum.accumulate(owner)
            last[:, at], step[:, at] = last[owner, at], step[owner, at]
        links, row, end = [], np.arange(n), sizes
        while len(row):
            links.append((row, last[row, end]))
            end = end - step[row, end]
            row, end = row[end > 0], end[end > 0]
        lengths = np.zeros(n, np.int64)
        for row, _ in links:
            lengths[row] += 1
        ends = np.cumsum(lengths)
        out = np.zeros(int(ends[-1]), np.int32)
        for back, (row, piece) in enumerate(links):
            out[ends[row] - 1 - back] = piece
        return out, lengths

    def spelled(self, numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``shown_ids`` of chains in a row, none of them empty."""
        other = numbers >= self.first_other
        if not other.any():
            return numbers, lengths
        kinds, at = np.unique(numbers[other], return_inverse=True)
        runs = Runs(np.int32)
        runs.add([self.shown_ids([k]) for k in kinds.tolist()])
        values, sizes = runs.take(at)
        times = np.ones(len(numbers), np.int64)
        times[other] = sizes
        out = np.repeat(numbers, times)
        out[np.repeat(other, times)] = values
        return out, np.add.reduceat(times, np.cumsum(lengths) - lengths)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words in a row, and their sizes."""
        order = sorted(range(len(words)), key=words.__getitem__)
        short = [i for i in order if len(words[i]) <= SHORT]
        long = [i for i in order if len(words[i]) > SHORT]
        found = Runs(np.int32)
        for at in range(0, len(short), TOGETHER):
            found.add_flat(*self.spelled(*self.chain_together([words[i] for i in short[at:at + TOGETHER]])))
        if long:
            chains = self.chains([words[i] for i in long])
            found.add([self.shown_ids(chains[words[i]]) for i in long])
        place = np.zeros(len(words), np.int64)
        place[short + long] = np.arange(len(words))
        return found.take(place)

    def shown_ids(self, chain: list[int]) -> list[int]:
        """Ids of a chain; characters that are no piece become their bytes."""
        if max(chain, default=0) < self.first_other:
            return chain
        out = []
        for i in chain:
            if i < self.first_other:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in self.text_of[i].encode("utf-8", "surrogatepass")]
            else:
                out.append(self.unknown)
        return out

    def numbers(self, pieces: list[str]) -> list[int]:
        return self.shown_ids([self.number(p) for p in pieces])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that begin and end at cuts, spaces shown as marks."""
        if len(self.words) > MEMO_WORDS:
            self.old_words, self.old_runs = self.words, self.runs
            self.words, self.runs = Numbered(), Runs(np.int32)
        at = []
        for text in texts:
            words = self.word.findall(text)
            at.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
        fresh, self.words.fresh = self.words.fresh, []
        if fresh:
            old = np.fromiter((self.old_words.get(w, -1) for w in fresh), np.int64, len(fresh))
            again = old >= 0
            found = Runs(np.int32)
            found.add_flat(*self.old_runs.take(old[again]))
            found.add_flat(*self.ids_of([w for w, n in zip(fresh, old.tolist()) if n < 0]))
            place = np.where(again, np.cumsum(again), again.sum() + np.cumsum(~again)) - 1
            self.runs.add_flat(*found.take(place))
        return [self.runs.take(numbers)[0] for numbers in at]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode_all(self, runs: list[np.ndarray]) -> list[str]:
        """Texts of id runs; their bytes are taken from one table, SPAN ids at a time."""
        ids = np.concatenate([np.zeros(0, np.int32), *runs])
        held, sizes_of = [], []
        for at in range(0, len(ids), SPAN):
            own = ids[at:at + SPAN]
            starts = self.bytes_at[own]
            sizes = self.bytes_at[own + 1] - starts
            total = np.cumsum(sizes, dtype=np.int32)
            where = np.arange(total[-1], dtype=np.int32) + np.repeat(starts - (total - sizes), sizes)
            held.append(self.bytes[where].tobytes())
            sizes_of.append(sizes)
        data = b"".join(held)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes_of]))])
        cuts = ends[np.cumsum([0, *map(len, runs)])].tolist()
        return [data[a:b].decode("utf-8", "each_byte") for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]


def words_of(pieces: Iterable[str]) -> re.Pattern:
    """Words that merges stay in: space marks, then characters that pieces connect, or one that none does."""
    set_of: dict[str, set[str]] = {}
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            if a != MARK and set_of.setdefault(a, {a}) is not set_of.setdefault(b, {b}):
                few, many = sorted((set_of[a], set_of[b]), key=len)
                many |= few
                for c in few:
                    set_of[c] = many
    sets = sorted({id(s): s for s in set_of.values()}.values(), key=lambda s: (-len(s), min(s)))
    sets[SETS:] = [set().union(*sets[SETS:])] if sets[SETS:] else []
    some = [f"[{''.join(map(re.escape, sorted(s)))}]+" for s in sets]
    return re.compile(f"{MARK}*(?:{'|'.join([*some, f'[^{MARK}]'])})|{MARK}+", re.DOTALL)


# ---------------------------------------------------------------------------
# Chunks
# ---------------------------------------------------------------------------
State = tuple[int, int]  # characters of a piece before the boundary, and from it on


@dataclass
class Chunk:
    """Characters ``begin:end`` of ``text``, whose margins hold what a piece over an edge can need."""

    text: str
    begin: int
    end: int

    def states(self, pieces: Pieces, at: int) -> list[State]:
        """Pieces that hold the character before a boundary, whatever leads to them."""
        out = []
        for stop in range(at, min(len(self.text), at + pieces.longest - 1) + 1):
            for piece in pieces.ending(self.text, stop):
                before = len(piece) - (stop - at)
                if before > 0:
                    out.append((before, stop - at))
        return out

    def free(self, first: bool) -> bool:
        """Whether the left end is a cut, where the one state is (0, 0)."""
        return first or (self.text[self.begin:self.begin + 1] == MARK and self.text[self.begin - 1] != MARK)

    @cached_property
    def cuts(self) -> tuple[int, int] | None:
        """First and last cut inside, if there is one."""
        marks = [m.start() for m in re.finditer(f"(?<=[^{MARK}]){MARK}", self.text) if self.begin <= m.start() <= self.end]
        return (marks[0], marks[-1]) if marks else None

    def walk(self, pieces: Pieces, state: State | None, at: int, stop: int) -> dict[tuple[int, str], tuple[int, tuple]]:
        """Best weights of (end, last piece) with end >= stop, for pieces that begin before it.

        ``state`` is the piece over the boundary ``at``; None says that ``at`` is a cut.
        """
        if state is None:
            first = {(at, ""): (0, ())}
            low = at
        else:
            low = at + state[1]
            first = {(low, self.text[at - state[0]:low]): (0, ())}
        by_end: dict[int, dict[str, tuple[int, tuple]]] = {low: {k[1]: v for k, v in first.items()}}
        out = {}
        if low >= stop:
            return {k: v for k, v in first.items()}
        for end in range(low + 1, min(len(self.text), stop + pieces.longest - 1) + 1):
            here: dict[str, tuple[int, tuple]] = {}
            for piece in pieces.ending(self.text, end):
                before = end - len(piece)
                if before >= stop:
                    continue
                for last, (weight, chain) in by_end.get(before, {}).items():
                    if pieces.meets(pieces.number(last) if last else -1, pieces.number(piece)) and (piece not in here or here[piece][0] < weight - 1):
                        here[piece] = weight - 1, (chain, piece)
            if end >= stop:
                out.update({(end, p): v for p, v in here.items()})
            else:
                by_end[end] = here
                by_end.pop(end - pieces.longest - 1, None)
        return out

    def _to(self, found: dict, at: int) -> dict[State, tuple[int, tuple]]:
        return {(len(p) - (e - at), e - at): v for (e, p), v in found.items()}

    def middle(self) -> str:
        """The text between the first and the last cut, whose ids do not depend on the states."""
        cuts = self.cuts
        return self.text[cuts[0]:cuts[1]] if cuts else ""

    def margins(self, pieces: Pieces) -> tuple[str, str, int, int]:
        """(head, tail, low, end): what tracing needs besides the middle's ids.

        The head goes on behind the first cut, ``low``, as far as a piece reaches; the tail begins a
        character before the last cut, and ``end`` is its place there.  Without cuts the head is
        everything and ``low`` is -1.
        """
        cuts = self.cuts
        if cuts is None:
            return self.text, "", -1, self.end
        return self.text[:cuts[0] + pieces.longest], self.text[cuts[1] - 1:], cuts[0], self.end - cuts[1] + 1

    def matrix(self, pieces: Pieces, first: bool, last: bool, middle: np.ndarray | None = None) -> dict[tuple[State, State], int]:
        """Weight of the best way between each left and each right state; a document's ends have one.

        ``middle`` are the ids between the cuts, where they are known.
        """
        free = self.free(first)
        lefts = [(0, 0)] if free else self.states(pieces, self.begin)
        cuts = self.cuts
        out: dict[tuple[State, State], int] = {}
        if cuts is None:
            for s in lefts:
                for t, (w, _) in self._right(self.walk(pieces, None if free else s, self.begin, self.end), last).items():
                    out[s, t] = w
            return out
        low, high = cuts
        weight = -len(pieces.encode(self.text[low:high]) if middle is None else middle)
        tails = self._right(self.walk(pieces, None, high, self.end), last)
        for s in lefts:
            if s[1] > low - self.begin:
                continue
            heads = self.walk(pieces, None if free else s, self.begin, low)
            head = max((w for (e, _), (w, _) in heads.items() if e == low), default=None)
            if head is not None:
                for t, (w, _) in tails.items():
                    out[s, t] = head + weight + w
        return out

    def _right(self, found: dict, last: bool) -> dict[State, tuple[int, tuple]]:
        if not last:
            return self._to(found, self.end)
        ends = [v for (e, _), v in found.items() if e == self.end]
        return {(0, 0): max(ends)} if ends else {}

    def trace(self, pieces: Pieces, first: bool, last: bool, left: State, right: State) -> np.ndarray:
        """Ids of the pieces that begin in the chunk, given its true states."""
        head, tail, low, end = self.margins(pieces)
        middle = pieces.encode(self.middle()) if low >= 0 else None
        return from_margins(pieces, head, tail, self.begin, low, end, middle, first, last, left, right)


def from_margins(
    pieces: Pieces, head: str, tail: str, begin: int, low: int, end: int, middle: np.ndarray | None,
    first: bool, last: bool, left: State, right: State,
) -> np.ndarray:
    """Ids of a chunk from its margins, the ids between its cuts, and its true states."""
    chunk = Chunk(head, begin, end if low < 0 else low)
    start = None if chunk.free(first) else left
    if low < 0:
        found = chunk._right(chunk.walk(pieces, start, begin, end), last)
        return np.array(pieces.numbers(_chain(found[right][1])), np.int32)
    heads = chunk.walk(pieces, start, begin, low)
    best = max((v for (e, _), v in heads.items() if e == low), key=lambda v: v[0])
    rest = Chunk(tail, 1, end)
    found = rest._right(rest.walk(pieces, None, 1, end), last)[right]
    return np.concatenate([
        np.array(pieces.numbers(_chain(best[1])), np.int32), middle, np.array(pieces.numbers(_chain(found[1])), np.int32)])


def _chain(link: tuple) -> list[str]:
    out = []
    while link:
        link, piece = link
        out.append(piece)
    return out[::-1]


def times(a: dict, b: dict) -> dict:
    """Max-plus product of two sparse matrices."""
    by_left: dict[State, list] = {}
    for (s, t), w in b.items():
        by_left.setdefault(s, []).append((t, w))
    out: dict = {}
    for (s, m), w in a.items():
        for t, v in by_left.get(m, ()):
            if out.get((s, t), -np.inf) < w + v:
                out[s, t] = w + v
    return out


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
_PIECES: dict[str, Pieces] = {}
_MATRIX = pa.list_(pa.struct([(n, pa.int32()) for n in ("a", "b", "c", "d")] + [("w", pa.int64())]))
_MATRIX_SQL = "array<struct<a:int,b:int,c:int,d:int,w:bigint>>"


def _pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _rows(matrix: dict) -> list[dict]:
    return [{"a": s[0], "b": s[1], "c": t[0], "d": t[1], "w": w} for (s, t), w in matrix.items()]


def _matrix(rows: list[dict]) -> dict:
    return {((r["a"], r["b"]), (r["c"], r["d"])): r["w"] for r in rows}


def _cut_up(giants: DataFrame, model: str, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        margin = 2 * pieces.longest
        for batch in batches:
            for i in range(batch.num_rows):
                text = pieces.lead + batch.column(1)[i].as_py().replace(" ", MARK)
                n = -(-len(text) // chunk)
                for k in range(0, n, 64):
                    some = range(k, min(n, k + 64))
                    low = [max(0, j * chunk - margin) for j in some]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[i].as_py()] * len(some), pa.int64()), pa.array(some, pa.int64()),
                        pa.array([n] * len(some), pa.int64()),
                        pa.array([text[a:(j + 1) * chunk + margin] for a, j in zip(low, some)], pa.string()),
                        pa.array([j * chunk - a for a, j in zip(low, some)], pa.int64()),
                        pa.array([min(len(text), (j + 1) * chunk) - a for a, j in zip(low, some)], pa.int64()),
                    ], ["doc", "part", "parts", "text", "begin", "end"])

    return giants.mapInArrow(run, "doc bigint, part bigint, parts bigint, text string, begin bigint, end bigint")


#: A chunk for tracing: its margins and the ids between them.
_TRACED = "head string, tail string, begin bigint, low bigint, end bigint, middle binary"


def _with_matrices(chunks: DataFrame, model: str) -> DataFrame:
    """(doc, part, parts, margins, ids of the middle, matrix): a chunk's middle is encoded here and only here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for part in slices(batch, 64):
                rows = part.to_pylist()
                cut = [Chunk(r["text"], r["begin"], r["end"]) for r in rows]
                middles = pieces.encode_all([c.middle() for c in cut])
                found = [_rows(c.matrix(pieces, r["part"] == 0, r["part"] == r["parts"] - 1, m)) for c, r, m in zip(cut, rows, middles)]
                head, tail, low, end = zip(*(c.margins(pieces) for c in cut)) if cut else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(head, pa.string()), pa.array(tail, pa.string()), part.column(4),
                     pa.array(low, pa.int64()), pa.array(end, pa.int64()),
                     pa.array([m.astype(pieces.narrow).tobytes() for m in middles], pa.binary()), pa.array(found, _MATRIX)],
                    ["doc", "part", "parts", "head", "tail", "begin", "low", "end", "middle", "matrix"])

    return chunks.mapInArrow(run, f"doc bigint, part bigint, parts bigint, {_TRACED}, matrix {_MATRIX_SQL}")


def _products(parts: DataFrame, *key: str) -> DataFrame:
    """The product of each group's matrices in order of ``part``; groups have BLOCK rows at most."""
    def product(table: pa.Table) -> pa.Table:
        out = None
        for row in sorted(table.select(["part", "matrix"]).to_pylist(), key=lambda r: r["part"]):
            own = _matrix(row["matrix"])
            out = own if out is None else times(out, own)
        first = table.slice(0, 1)
        return pa.table([first.column(k) for k in key] + [pa.array([_rows(out)], _MATRIX)], names=[*key, "matrix"])

    return parts.groupBy(*key).applyInArrow(product, ", ".join(f"{k} bigint" for k in key) + f", matrix {_MATRIX_SQL}")


def _states(parts: DataFrame, *key: str) -> DataFrame:
    """(key, part, a, b, c, d): left and right state of every part on the best way.

    Rows may bring ``left`` and ``right``, the states at the group's ends; a document's are (0, 0).
    """
    def scan(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        a, b, c, d = (rows[0][k] for k in "abcd")
        best: dict[State, tuple[int, tuple]] = {(a, b): (0, ())}
        for row in rows:
            step: dict[State, tuple[int, tuple]] = {}
            for (s, t), w in _matrix(row["matrix"]).items():
                if s in best and (t not in step or step[t][0] < best[s][0] + w):
                    step[t] = best[s][0] + w, (best[s][1], t)
            best = step
        at = _chain(best[c, d][1])
        lefts = [(a, b), *at[:-1]]
        return pa.table(
            [pa.array([r[k] for r in rows], pa.int64()) for k in [*key, "part"]]
            + [pa.array(x, pa.int32()) for x in ([s[0] for s in lefts], [s[1] for s in lefts], [s[0] for s in at], [s[1] for s in at])],
            names=[*key, "part", "a", "b", "c", "d"])

    return parts.groupBy(*key).applyInArrow(
        scan, ", ".join(f"{k} bigint" for k in [*key, "part"]) + ", a int, b int, c int, d int")


def encode(
    df: DataFrame, model: str, chunk: int = CHUNK, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, part, ids): the ids of every text as little-endian 32-bit numbers, in parts.

    A text of up to ``chunk`` characters is one part; longer ones have a part for each chunk.  Null
    and empty texts are one part without ids.  Repeated rows are encoded each: parts carry ``row``,
    a number of the input row.  Other columns are left out.
    """
    kind = df.schema[id_col].dataType
    rows = df.select(df[id_col].alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    giant = F.char_length("text") > chunk - 1

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for part in slices(batch):
                texts = [pieces.lead + t.replace(" ", MARK) if t else "" for t in strings(part.column(1))]
                ids = [i.astype("<i4").tobytes() for i in pieces.encode_all(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([0] * part.num_rows, pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "part", "ids"])

    small = rows.filter(~giant).mapInArrow(whole, f"id {kind.simpleString()}, part bigint, ids binary").withColumn(
        "row", F.lit(None).cast("long"))
    # Giant documents get a number of their own, so that ids may repeat or be null.
    numbered = written(rows.filter(giant).withColumn("doc", F.monotonically_increasing_id()))
    chunks = written(_with_matrices(_cut_up(numbered.select("doc", "text"), model, chunk).repartition("doc", "part"), model))
    blocks = chunks.select("doc", F.floor(F.col("part") / block).alias("block"), "part", "matrix")
    of_block = _products(blocks, "doc", "block")
    ends = [F.lit(0).alias(k) for k in "abcd"]
    block_states = _states(of_block.select("doc", F.col("block").alias("part"), "matrix", *ends), "doc").withColumnRenamed("part", "block")
    chunk_states = _states(blocks.join(block_states, ["doc", "block"]), "doc", "block").drop("block")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for part in slices(batch, 64):
                ids = [from_margins(
                    pieces, r["head"], r["tail"], r["begin"], r["low"], r["end"], np.frombuffer(r["middle"], pieces.narrow).astype(np.int32),
                    r["part"] == 0, r["part"] == r["parts"] - 1, (r["a"], r["b"]), (r["c"], r["d"])
                ).astype("<i4").tobytes() for r in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.binary())], ["doc", "part", "ids"])

    traced = chunks.drop("matrix").join(chunk_states, ["doc", "part"]).mapInArrow(trace, "doc bigint, part bigint, ids binary")
    large = traced.join(numbered.select("doc", "id"), "doc").select("id", "part", "ids", F.col("doc").alias("row"))
    return small.union(large).withColumnRenamed("id", id_col)


def decode(parts: DataFrame, model: str, id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """(id, row, part, text), with ``keep_ids`` also ids, of parts as ``encode`` gives them; a text is its parts in order.

    The space put before a text is taken off its first part.  Bytes that are no UTF-8 become
    U+FFFD each, null ids an empty text.
    """
    kind = parts.schema[id_col].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for some in slices(batch):
                texts = pieces.decode_all([np.frombuffer(ids or b"", "<i4") for ids in some.column(3).to_pylist()])
                texts = [t[1:] if pieces.lead and k == 0 and t.startswith(" ") else t
                         for t, k in zip(texts, some.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(arrow), some.column(1), some.column(2), pa.array(texts, pa.string()),
                     *([some.column(3)] if keep_ids else [])],
                    ["id", "row", "part", "text", *(["ids"] if keep_ids else [])])

    return parts.select(parts[id_col].alias("id"), "row", "part", "ids").mapInArrow(
        run, f"id {kind.simpleString()}, row bigint, part bigint, text string" + ", ids binary" * keep_ids
    ).withColumnRenamed("id", id_col)
