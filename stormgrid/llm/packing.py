"""Packing documents into training sequences of several lengths.

Each task packs the rows it reads as they come, in bounded memory and without a shuffle:

* a document longer than the longest window gives whole windows of its own first; documents wait
  in a stock until there are enough to choose from;
* a document, the longest first, opens a window of the shortest tier that holds it, and the gap is
  filled with the longest documents that still fit, which come from the same or shorter tiers; two
  that fill a gap exactly are preferred;
* a gap that no whole document fits is filled from one document kept for cutting, first of all what
  is left of one that had to be cut anyway, so every window is full and few documents are cut;
* when the task ends, the last tokens are cut at powers of two, which need no padding;
* windows are dealt to step groups of the same number of tokens, the longest first; the last groups
  of a task share what there is evenly.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from stormgrid.llm.pieces import SPECIAL, Numbered, Runs, split
from stormgrid.llm.texts import slices, strings

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 1 << 16
MEMO_PIECES = 800_000
#: Tokens and documents that wait to be packed, and full step groups held back to even out the last ones.
STOCK_TOKENS = 1 << 19
STOCK_ITEMS = 20_000
HELD_GROUPS = 20
#: Lengths tried for a pair that fills a gap, and remainders of long documents kept for cutting.
PAIRS = 48
SPARES = 4


class PieceIds:
    """Token ids of texts by the library, asked once for each distinct piece."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.sizes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.sizes[i] = len(token)  # one stand-in character a byte
        self.newline = self.library.encode("\n", add_special_tokens=False).ids
        self.memo_pieces = memo_pieces
        self._start()

    def _start(self) -> None:
        self.numbers, self.runs = Numbered(), Runs(np.uint16 if len(self.sizes) <= 1 << 16 else np.uint32)

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece.  Words are encoded in one text, with a line end between them.

        Tokens never cross pieces, so the bytes tokens stand for show where each piece ends.
        """
        out: list[np.ndarray | None] = [None] * len(pieces)
        words = [i for i, p in enumerate(pieces) if not p[-1].isspace() and not p[0].isspace() and p != SPECIAL]
        words += [i for i, p in enumerate(pieces) if p[0] == " " and len(p) > 1 and not p[-1].isspace()]
        alone = sorted(set(range(len(pieces))) - set(words))
        for i, found in zip(alone, self.library.encode_batch([pieces[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(found.ids, np.int64)
        for at in range(0, len(words), 4096):
            some = words[at:at + 4096]
            spaced = [pieces[i] if pieces[i][0] == " " else "\n" + pieces[i] for i in some]
            ids = np.array(self.library.encode("".join(spaced), add_special_tokens=False).ids, np.int64)
            ends = np.cumsum([len(p.encode("utf-8")) for p in spaced])
            cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
            for i, a, b in zip(some, [0, *cuts[:-1].tolist()], cuts.tolist()):
                out[i] = ids[a:b] if pieces[i][0] == " " else ids[a + len(self.newline):b]
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; pieces none of them had before are encoded together."""
        if len(self.numbers) > self.memo_pieces:
            self._start()
        marked = []
        for text in texts:
            pieces = split(text)
            marked.append(np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces)))
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            self.runs.add(self._encode(fresh))
        return [self.runs.take(numbers)[0] for numbers in marked]


class Stock:
    """Pieces (doc, start) by length."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []
        self.items = self.tokens = 0

    def put(self, doc: object, start: int, length: int) -> None:
        own = self.by_length.get(length)
        if own is None:
            own = self.by_length[length] = []
            insort(self.lengths, length)
        own.append((doc, start))
        self.items += 1
        self.tokens += length

    def take(self, length: int) -> tuple:
        own = self.by_length[length]
        doc, start = own.pop()
        if not own:
            del self.by_length[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.items -= 1
        self.tokens -= length
        return doc, start, length

    def longest(self, most: int) -> int:
        """The longest length up to ``most``, 0 without any."""
        at = bisect_right(self.lengths, most)
        return self.lengths[at - 1] if at else 0

    def fitting(self, room: int) -> int:
        """The length to put into a gap: exactly it, one of two that fill it, or the longest that fits."""
        at = bisect_right(self.lengths, room)
        if not at:
            return 0
        best = self.lengths[at - 1]
        if best < room:
            for i in range(at - 1, max(-1, at - 1 - PAIRS), -1):
                other = room - self.lengths[i]
                if other in self.by_length and (other != self.lengths[i] or len(self.by_length[other]) > 1):
                    return self.lengths[i]
        return best


class Packer:
    """Places token counts; ``placed`` gets (doc, start, length, sequence, offset, tier, group)."""

    def __init__(self, tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers = sorted(tiers)
        if step_tokens % self.tiers[-1]:
            raise ValueError("a step group must be whole windows of the longest tier")
        self.step_tokens = step_tokens
        self.stock = Stock()
        self.spares: list[tuple] = []  # what is kept for cutting; the last one is being cut
        self.windows: list[tuple] = []  # (size, sequence, pieces), not yet dealt to groups
        self.waiting = 0  # tokens of those windows
        self.next_sequence = self.next_group = 0
        self.placed: list[tuple] = []

    def add(self, doc: object, tokens: int) -> None:
        longest = self.tiers[-1]
        whole = tokens // longest * longest
        for start in range(0, whole, longest):
            self._close(longest, [(doc, start, longest)])
        if whole < tokens:
            if whole and len(self.spares) < SPARES:
                self.spares.insert(0, (doc, whole, tokens - whole))
            else:
                self.stock.put(doc, whole, tokens - whole)
        if self.stock.tokens > STOCK_TOKENS:
            while self.stock.tokens > STOCK_TOKENS // 2:
                self._pack(longest)
        if self.stock.items > STOCK_ITEMS:
            while self.stock.items > STOCK_ITEMS // 2 and self._pack(self.stock.lengths[self._middle()]):
                pass

    def _middle(self) -> int:
        """The place in the lengths up to which about half the documents are."""
        seen = 0
        for i, length in enumerate(self.stock.lengths):
            seen += len(self.stock.by_length[length])
            if 2 * seen >= self.stock.items:
                break
        return i

    def _tokens(self) -> int:
        return self.stock.tokens + sum(s[2] for s in self.spares)

    def _pack(self, most: int) -> bool:
        """Fill one window that begins with the longest document up to ``most`` tokens."""
        first = self.stock.longest(most)
        size = next((t for t in self.tiers if t >= max(first, 1)), self.tiers[-1])
        if not first or self._tokens() < size:
            return False
        pieces, room = [self.stock.take(first)], size - first
        while room and (length := self.stock.fitting(room)):
            pieces.append(self.stock.take(length))
            room -= length
        while room:
            if not self.spares:
                self.spares.append(self.stock.take(self.stock.lengths[-1]))
            doc, start, length = self.spares.pop()
            here = min(room, length)
            pieces.append((doc, start, here))
            room -= here
            if here < length:
                self.spares.append((doc, start + here, length - here))
        self._close(size, pieces)
        return True

    def _close(self, size: int, pieces: list[tuple]) -> None:
        self.windows.append((size, self.next_sequence, pieces))
        self.next_sequence += 1
        self.waiting += size
        if self.waiting >= 2 * HELD_GROUPS * self.step_tokens:
            self._deal(self.waiting // self.step_tokens - HELD_GROUPS)

    def _deal(self, groups: int) -> None:
        """Windows to so many full groups.  Sizes are powers of two, so taken from the largest they fill a group."""
        self.windows.sort(key=lambda w: (-w[0], w[1]))
        at = 0
        for _ in range(groups):
            room, begin = self.step_tokens, at
            while at < len(self.windows) and self.windows[at][0] <= room:
                room -= self.windows[at][0]
                at += 1
            self._place(self.windows[begin:at])
        self.waiting -= sum(w[0] for w in self.windows[:at])
        del self.windows[:at]

    def _place(self, windows: list[tuple]) -> None:
        for size, sequence, pieces in windows:
            offset = 0
            for doc, start, length in pieces:
                self.placed.append((doc, start, length, sequence, offset, size, self.next_group))
                offset += length
        self.next_group += 1

    def end(self) -> None:
        while self._pack(self.tiers[-1]):
            pass
        pieces = [*self.spares, *(self.stock.take(self.stock.lengths[-1]) for _ in range(self.stock.items))]
        self.spares = []
        left = sum(p[2] for p in pieces)
        while left:
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            left -= size
            window, room = [], size
            while room:
                doc, start, length = pieces.pop(0)
                here = min(length, room)
                window.append((doc, start, here))
                room -= here
                if here < length:
                    pieces.insert(0, (doc, start + here, length - here))
            self._close(size, window)
        # The last groups share the windows evenly: the longest first, each to the group with the least.
        load = [(0, i) for i in range(-(-self.waiting // self.step_tokens))]
        dealt: list[list[tuple]] = [[] for _ in load]
        for window in sorted(self.windows, key=lambda w: (-w[0], w[1])):
            tokens, i = heapq.heappop(load)
            dealt[i].append(window)
            heapq.heappush(load, (tokens + window[0], i))
        for windows in dealt:
            self._place(windows)
        self.windows, self.waiting = [], 0


_IDS: dict[str, PieceIds] = {}


def pack(
    df: DataFrame, vocabulary: str, tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS,
    end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group.

    A document is its token ids, then ``end_id``; every id is in exactly one piece.  Null and empty
    texts are the end id alone; repeated rows are packed each.  Numbers of sequences and groups
    carry the partition, so they are unique over the table and the same when a task is retried.
    Tiers must be powers of two.  Columns besides id and text are left out.
    """
    kind = df.schema[id_col].dataType
    id_kind = to_arrow_type(kind)
    tiers = tuple(tiers)
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _IDS:
            _IDS[vocabulary] = PieceIds(vocabulary)
        library = _IDS[vocabulary]
        packer = Packer(tiers, step_tokens)
        base = TaskContext.get().partitionId() << 36
        documents: dict[int, tuple] = {}  # of the pieces not yet handed back
        n = 0
        for batch in batches:
            for part in slices(batch, 256):
                for doc_id, ids in zip(part.column(0).to_pylist(), library.ids(strings(part.column(1)))):
                    data = np.append(ids, ids.dtype.type(end_id)).astype("<u4").tobytes()
                    documents[n] = doc_id, data, len(ids) + 1
                    packer.add(n, len(ids) + 1)
                    n += 1
                yield _placed(packer, documents, base, id_kind)
        packer.end()
        yield _placed(packer, documents, base, id_kind)

    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return rows.mapInArrow(
        run, f"id {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, "
             "sequence_id bigint, offset bigint, tier int, step_group bigint"
    )


def _placed(packer: Packer, documents: dict[int, tuple], base: int, kind: pa.DataType) -> pa.RecordBatch:
    placed, packer.placed = packer.placed, []
    rows = []
    for n, start, length, sequence, offset, tier, group in placed:
        doc_id, data, left = documents[n]
        rows.append((doc_id, start, length, data[4 * start:4 * (start + length)], len(data) // 4,
                     base + sequence, offset, tier, base + group))
        documents[n] = doc_id, data, left - length
        if left == length:
            del documents[n]
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

