"""Removing byte strings that occurred earlier in the corpus, judged by suffix arrays.

A string of ``length`` bytes is found through its anchor, the gram in it with the least hash: equal
strings have equal anchors at equal offsets, and neighbouring strings share one.  So a document is
a list of runs of string starts with one anchor each, about one run every 35 bytes.

1. Every task lists the runs of its documents with a hash of each run's bytes.  Of runs equal in a
   task only the first goes on, so copies shrink before any shuffle.
2. Runs meet by anchor hash.  Of equal runs the first stays and the others are late; an anchor
   with one content only is done with then.
3. Runs of anchors with several contents fetch their bytes from the documents and meet again by
   anchor, or, where an anchor has more runs than an average partition, string by string.  A block of runs is sorted as
   suffixes in two stages and adjacent common prefixes of ``length`` bytes or more mark equal strings.
   A string by itself can be in any share of the documents, so it is a tournament: of equal ones
   only the earliest goes on from a slice of documents, then from a salt, and those of all salts
   meet at last.  Whatever drops out on the way has an earlier equal, so it is late.
4. Late starts are gathered by document and the bytes they cover are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid.llm.texts import utf8, written

LENGTH = 100
GRAM = 32
#: Bytes whose grams are hashed at a time, and bytes of runs sorted at a time (some 60 times that in memory).
SPAN = 1 << 22
BLOCK_BYTES = 1 << 20
#: Bytes of documents read, and of single strings listed, at a time.
SLICE_BYTES = 1 << 23
#: An anchor is crowded, and its strings are compared one by one, above an average partition's runs:
#: at least so many, and at most as many as one block sorts.  Being relative, it is the same share
#: of anchors at every size, until runs of an anchor would no longer fit a block.
HOT_RUNS = 256
MOST_RUNS = BLOCK_BYTES // 128
_NO_ID = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------------------
# Two-stage suffix sorting
# ---------------------------------------------------------------------------
def _smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; of equal bytes the next difference decides."""
    up = np.empty(len(text), bool)
    up[:-1] = text[:-1] < text[1:]
    up[-1] = True
    differs = np.empty(len(text), bool)
    differs[:-1] = text[:-1] != text[1:]
    differs[-1] = True
    at = np.where(differs, np.arange(len(text)), len(text))
    return up[np.minimum.accumulate(at[::-1])[::-1]]


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Starts where ``wanted`` holds, in order of their suffixes to ``depth`` bytes at least.

    ``text`` is bytes above zero with zeros as separators, and ends in one.  Suffixes smaller than
    their successor are sorted directly; the others follow from scans of the buckets of first
    bytes, from the least: a suffix larger than its successor goes to the front part of its bucket
    in the order in which its successor is met.
    """
    small = _smaller_than_successor(text)
    # A larger suffix is placed through its successors up to the next smaller one.
    at = np.arange(len(text))
    next_small = np.minimum.accumulate(np.where(small, at, len(text))[::-1])[::-1]
    held = np.zeros(len(text) + 1, np.int32)
    starts = np.flatnonzero(wanted)
    np.add.at(held, starts, 1)
    np.add.at(held, np.minimum(next_small[starts] + 1, len(text)), -1)
    held = np.cumsum(held)[:-1] > 0

    direct = np.flatnonzero(held & small)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    direct = direct[np.argsort(np.ascontiguousarray(rows[direct]).view(f"V{depth}").ravel(), kind="stable")]
    first = np.searchsorted(text[direct], np.arange(257))

    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        front = fronts[byte]
        level = np.concatenate(front) if front else direct[:0]
        front = [level]
        while len(level):
            level = level[level > 0] - 1
            level = level[(text[level] == byte) & held[level] & ~small[level]]
            front.append(level)
        bucket = np.concatenate([*front, direct[first[byte]:first[byte + 1]]])
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[held[before] & (text[before] > byte)]
        if len(before):
            bytes_before = text[before]
            turn = np.argsort(bytes_before, kind="stable")
            before, bytes_before = before[turn], bytes_before[turn]
            cuts = np.flatnonzero(np.diff(bytes_before)) + 1
            for part in np.split(before, cuts):
                fronts[text[part[0]]].append(part)
    order = np.concatenate(order) if order else direct
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Bytes each start of ``order`` has in common with the one before it, ``length`` at most."""
    out = np.zeros(len(order), np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    for at in range(1, len(order), 1 << 16):
        here = order[at:at + (1 << 16)]
        differs = rows[here] != rows[order[at - 1:at - 1 + len(here)]]
        out[at:at + len(here)] = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
    return out


def late_starts(data: np.ndarray, run_at: np.ndarray, starts: np.ndarray, rank: np.ndarray, at: np.ndarray,
                length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Which strings have an equal one earlier in order.

    Run r is ``data[run_at[r]:run_at[r + 1]]`` and has ``starts[r]`` strings; its document is
    ``rank[r]``-th in order and its first string starts there at byte ``at[r]``.  Returns, string
    by string in order of runs, whether it is late, and its run.
    """
    n = int(starts.sum())
    run = np.repeat(np.arange(len(starts), dtype=np.int32), starts)
    if not n:
        return np.zeros(0, bool), run
    sizes = np.diff(run_at)
    text = np.zeros(len(data) + len(sizes) + length, np.uint8)  # one separator a run
    where = np.arange(len(data), dtype=np.int32) + np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    text[where] = data + np.uint8(1)  # UTF-8 has no byte 255
    within = np.arange(n, dtype=np.int32) - np.repeat((np.cumsum(starts) - starts).astype(np.int32), starts)
    place = run_at.astype(np.int32)[run] + run + within
    wanted = np.zeros(len(text), bool)
    wanted[place] = True
    order = two_stage_order(text, wanted, length + 4)
    heads = common_prefixes(text, order, length) < length
    heads[0] = True
    position = np.zeros(len(text), np.int32)
    position[place] = np.arange(n, dtype=np.int32)
    string = position[order]
    key = rank[run[string]].astype(np.int64) << 32 | (at[run[string]] + within[string])
    edges = np.flatnonzero(heads)
    least = np.repeat(np.minimum.reduceat(key, edges), np.diff(np.append(edges, len(order))))
    late = np.zeros(n, bool)
    late[string] = key > least
    return late, run


# ---------------------------------------------------------------------------
# Anchors
# ---------------------------------------------------------------------------
def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each start, by doubling."""
    code = data.astype(np.uint64) + np.uint64(1)
    size = 1
    while size < GRAM:
        mixed = code[:-size] * _MIX
        mixed ^= mixed >> np.uint64(32)
        code = mixed * np.uint64(0xC2B2AE3D27D4EB4F) + code[size:]
        size *= 2
    code = code ^ (code >> np.uint64(29))
    return code * _MIX


def anchor_runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, number of starts) of the runs of one document's bytes.

    Long documents are gone through span by span; a run cut at a span's end is two runs.
    """
    keys, lows, counts = [], [], []
    window = length - GRAM + 1
    for begin in range(0, max(0, len(data) - length + 1), SPAN):
        part = data[begin:begin + SPAN + length - 1]
        hashes = _gram_hashes(part)
        # The least hash and, among equal ones, the leftmost: hash bits above, position below.
        least = (hashes & ~np.uint64((1 << 23) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        have = 1
        while have < window:
            step = min(have, window - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        low = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        keys.append(hashes[(least[low] & np.uint64((1 << 23) - 1)).astype(np.int64)])
        lows.append(low + begin)
        counts.append(np.diff(np.append(low, len(least))))
    if not keys:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    return np.concatenate(keys), np.concatenate(lows), np.concatenate(counts)


def _stretches(late: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of equal flag inside runs: (first string, number of strings, flag)."""
    if not len(late):
        none = np.zeros(0, np.int64)
        return none, none, late
    first = np.flatnonzero(np.concatenate([[True], (late[1:] != late[:-1]) | (run[1:] != run[:-1])]))
    return first, np.diff(np.append(first, len(late))), late[first]


def _content_hashes(data: np.ndarray, low: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[low:low + size]`` for each run."""
    held = data.tobytes()
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(held[a:b]) for a, b in zip(low.tolist(), (low + sizes).tolist())), np.uint64, len(low))


KIND_ALONE, KIND_WITNESS, KIND_MET, KIND_LATE = range(4)
#: Bits of an anchor's hash that are kept; equal bits only bring runs together.
_KEY_BITS = np.uint64(48)


def _runs_of(ids: np.ndarray, hashes: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int) -> pa.RecordBatch:
    """The runs of some documents; of equal ones the first as such and the others as late."""
    keys, contents, doc, low, count = [], [], [], [], []
    order = np.lexsort((hashes, ids))  # so that the first of equal runs is the earliest
    for i in order.tolist():
        own = data[offsets[i]:offsets[i + 1]]
        k, a, n = anchor_runs(own, length)
        keys.append(k >> (np.uint64(64) - _KEY_BITS))
        contents.append(_content_hashes(own, a, n + length - 1))
        low.append(a)
        count.append(n)
        doc.append(np.full(len(k), i))
    key, content, low, count, doc = map(np.concatenate, (keys, contents, low, count, doc))
    kind = np.full(len(key), KIND_ALONE)
    turn = np.lexsort((content, key))
    same_key = np.concatenate([[False], key[turn][1:] == key[turn][:-1]])
    equal = same_key & np.concatenate([[False], content[turn][1:] == content[turn][:-1]])
    # The sort is stable, so of equal runs the earliest comes first; the same document and place is not late.
    kind[turn[equal]] = KIND_LATE
    head = np.flatnonzero(~equal)
    place = (ids[doc[turn]], hashes[doc[turn]], low[turn])
    at_head = head[np.cumsum(~equal) - 1] if len(turn) else head
    again = equal & np.all([p == p[at_head] for p in place], axis=0) if len(turn) else equal
    kind[turn[again]] = -1
    # An anchor with several contents here: its runs go apart, and one row tells the others.
    first = turn[~equal]
    several = np.concatenate([[False], key[first][1:] == key[first][:-1], [False]])
    met = several[1:] | several[:-1]
    kind[first[met]] = KIND_MET
    tell = first[met & ~several[:-1]] if len(first) else first
    going = np.concatenate([np.flatnonzero(kind >= 0), tell])
    kind = np.concatenate([kind[kind >= 0], np.full(len(tell), KIND_WITNESS)])
    return pa.RecordBatch.from_arrays(
        [pa.array(key[going].view(np.int64)), pa.array(content[going].view(np.int64)), pa.array(ids[doc[going]]),
         pa.array(hashes[doc[going]]), pa.array(low[going]), pa.array(count[going]), pa.array(kind.astype(np.int32))],
        ["key", "content", "id", "hash", "low", "count", "kind"])


def _blocks(keys: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Slices of rows sorted by key, of about BLOCK_BYTES each, cut between keys."""
    if not len(keys):
        return
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(keys):
        end = int(np.searchsorted(total, total[begin] + BLOCK_BYTES))
        nth = int(np.searchsorted(heads, max(end, begin + 1)))
        end = int(heads[nth]) if nth < len(heads) else len(keys)
        yield slice(begin, end)
        begin = end


def _bytes_of(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - (ends - sizes), sizes)
    return data[where], np.concatenate([[0], ends])


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
_RUN_COLUMNS = ("key", "id", "hash", "low", "count")
_RUN = ", ".join(f"{c} bigint" for c in _RUN_COLUMNS)


def _documents(df: DataFrame, id_col: str, text_col: str, unique: bool, *more: Column) -> DataFrame:
    """(id, hash, text, ...): null ids come last in order, rows of one id go by their content's hash."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    return df.select(
        F.coalesce(df[id_col].cast("long"), F.lit(_NO_ID)).alias("id"),
        (F.lit(0).cast("long") if unique else F.xxhash64(text)).alias("hash"), text.alias("text"), *more,
    )


def _packed(documents: DataFrame, *more: str) -> DataFrame:
    """(id, hash, packed, ...): texts compressed row by row for a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [pack(t) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), *batch.columns[3:]],
                ["id", "hash", "packed", *more])

    rows = documents.select("id", "hash", "text", *more)
    tail = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in more)
    return rows.mapInArrow(run, f"id bigint, hash bigint, packed binary{tail}")


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(v) for v in column.to_pylist()], pa.large_binary())


def _listed(documents: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data, offsets = utf8(batch.column(2))
                yield _runs_of(batch.column(0).to_numpy(), batch.column(1).to_numpy(), data, offsets, length)

    return documents.select("id", "hash", "text").mapInArrow(
        run, "key bigint, content bigint, id bigint, hash bigint, low bigint, count bigint, kind int")


def _met(runs: DataFrame) -> DataFrame:
    """Runs to be compared (kind MET) and late ones (kind LATE); the rest is left out.

    Rows of an anchor meet, at most one a content and task; those known to be compared meet by
    content, late ones only pass.
    """
    part = F.when(F.col("kind") < KIND_MET, F.col("key")).when(
        F.col("kind") == KIND_MET, F.xxhash64("key", "content")).otherwise(F.xxhash64("id", "low"))
    anchor = Window.partitionBy("part", "key")
    equal = Window.partitionBy("part", "key", "content").orderBy("id", "hash", "low")
    place = F.struct("id", "hash", "low")
    marked = runs.withColumn("part", part).select(
        *_RUN_COLUMNS, "kind", (F.first(place).over(equal) == place).alias("leads"),
        ((F.min("content").over(anchor) != F.max("content").over(anchor))
         | (F.max((F.col("kind") == KIND_WITNESS).cast("int")).over(anchor) == 1)).alias("several"),
    )
    kind = (
        F.when(F.col("kind") == KIND_LATE, KIND_LATE).when(F.col("kind") == KIND_WITNESS, KIND_ALONE)
        .when(~F.col("leads"), KIND_LATE)
        .when((F.col("kind") == KIND_MET) | F.col("several"), KIND_MET).otherwise(KIND_ALONE)
    )
    return marked.select(*_RUN_COLUMNS, kind.alias("kind")).filter(F.col("kind") >= KIND_MET)


def _first_of_equal(strings: list[bytes], order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which strings have an equal one before them in ``order``; one at the same place is not before."""
    first: dict[bytes, int] = {}
    late = np.zeros(len(strings), bool)
    for i in order.tolist():
        at = first.setdefault(strings[i], i)
        late[i] = at != i and place[at] != place[i]
    return late


def _slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of rows of at most so many bytes, or of one row."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, side="right")) - 1)
        yield slice(begin, end)
        begin = end


def _unpacked_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of a batch with their texts, at most 256 at a time and about SLICE_BYTES of text."""
    unpack = zstandard.ZstdDecompressor().decompress
    begin, held, size = 0, [], 0
    for row in range(batch.num_rows):
        held.append(unpack(batch.column(2)[row].as_py()))
        size += len(held[-1])
        if size >= SLICE_BYTES or len(held) == 256 or row == batch.num_rows - 1:
            yield batch.slice(begin, len(held)), held
            begin, held, size = row + 1, [], 0


def _with_bytes(documents: DataFrame, runs: DataFrame, length: int, hot_runs: int | None) -> tuple[DataFrame, bool]:
    """Every run with its bytes and the key it is compared under, and whether there are single strings.

    Single strings have ``single`` set; rows without bytes are known to be late.
    """
    salts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(HOT_RUNS, min(runs.count() // salts, MOST_RUNS)) if hot_runs is None else hot_runs
    hot = written(runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select(
        "key", F.lit(True).alias("hot")))
    none = hot.isEmpty()
    runs = runs.withColumn("hot", F.lit(False)) if none else runs.join(hot, "key", "left")
    of_document = runs.groupBy("id", "hash").agg(
        F.collect_list(F.struct("key", "low", "count", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))

    def singles(ids, hashes, low, count, at, data) -> Iterator[pa.RecordBatch]:
        """Runs of very frequent anchors, string by string, under a salted hash of their bytes."""
        for some in _slices(count * length, SLICE_BYTES):
            times = count[some]
            run = np.repeat(np.arange(len(times)), times)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
            start, i, h = low[some][run] + nth, ids[some][run], hashes[some][run]
            begin = int(at[some].min())
            held = data[begin:int((at[some] + times).max()) + length - 1].tobytes()
            strings = [held[a:a + length] for a in (at[some][run] + nth - begin).tolist()]
            order = np.lexsort((start, h, i))
            turn = np.diff(i[order]).astype(bool) | np.diff(h[order]).astype(bool) | np.diff(start[order]).astype(bool)
            place = np.empty(len(order), np.int64)
            place[order] = np.cumsum(np.concatenate([[0], turn]))
            late = _first_of_equal(strings, order, place)
            first, size, flag = _stretches(late, run)
            first, size = first[flag], size[flag]
            go = np.flatnonzero(~late)
            mixed = (i.view(np.uint64) * _MIX + start.astype(np.uint64)) * _MIX
            salt = ((mixed >> np.uint64(32)) % np.uint64(salts)).astype(np.int64)
            key = np.fromiter((xxhash.xxh64_intdigest(strings[g], int(salt[g])) - (1 << 63) for g in go.tolist()), np.int64, len(go))
            of = np.concatenate([go, first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([key, mixed[first].view(np.int64)])), pa.array(i[of]), pa.array(h[of]),
                 pa.array(start[of]), pa.array(np.concatenate([np.ones(len(go), np.int64), size])),
                 pa.array([strings[g] for g in go.tolist()] + [None] * len(first), pa.binary()),
                 pa.array(np.ones(len(of), bool))], [*_RUN_COLUMNS, "bytes", "single"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _unpacked_slices(batch):
                data = np.frombuffer(b"".join(texts), np.uint8)
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                lists = part.column(3)
                of = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                key, low, count, hot = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
                ids, hashes = part.column(0).to_numpy()[of], part.column(1).to_numpy()[of]
                turn = np.flatnonzero(hot)
                yield from singles(ids[turn], hashes[turn], low[turn], count[turn], (offsets[of] + low)[turn], data)
                rest = np.flatnonzero(~hot)
                for some in _slices((count + length - 1)[rest], SLICE_BYTES):
                    r = rest[some]
                    text, cuts = _bytes_of(data, offsets[of[r]] + low[r], count[r] + length - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[r]), pa.array(ids[r]), pa.array(hashes[r]), pa.array(low[r]), pa.array(count[r]),
                         pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(text.tobytes())]),
                         pa.array(np.zeros(len(r), bool))], [*_RUN_COLUMNS, "bytes", "single"])

    rows = _packed(documents).join(of_document, ["id", "hash"]).mapInArrow(run, f"{_RUN}, bytes binary, single boolean")
    return rows, not none


def _late(runs: DataFrame, length: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, hash, low, count, bytes): stretches of late starts, and with bytes the single strings that go on.

    Runs of one anchor are held until the next begins; of single strings, which can be any number,
    only those not late so far.
    """
    names = ["id", "hash", "low", "count", "bytes"]

    def judge(key, ids, hashes, low, count, parts, single) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Late stretches block by block, with the rows of single strings that are not late."""
        data = np.frombuffer(b"".join(parts), np.uint8)
        at = np.concatenate([[0], np.cumsum(count + length - 1)])
        for some in _blocks(key, count + length - 1):
            i, h, a, n = ids[some], hashes[some], low[some], count[some]
            order = np.lexsort((h, i))
            rank = np.empty(len(i), np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], (np.diff(i[order]) != 0) | (np.diff(h[order]) != 0)]))
            late, run = late_starts(data[at[some.start]:at[some.stop]], at[some.start:some.stop + 1] - at[some.start], n, rank, a, length)
            first, size, flag = _stretches(late, run)
            own = run[first[~flag]]
            first, size = first[flag], size[flag]
            of = run[first]
            start = a[of] + first - (np.cumsum(n) - n)[of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[of]), pa.array(h[of]), pa.array(start), pa.array(size), pa.nulls(len(of), pa.binary())],
                names), own[single[some][own]] + some.start

    def going(rows: np.ndarray, ids, hashes, low, count, parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c[rows]) for c in (ids, hashes, low, count)), pa.array([parts[r] for r in rows.tolist()], pa.binary())], names)

    def judged(columns: list) -> Iterator[pa.RecordBatch]:
        for found, on in judge(*columns):
            yield found
            if len(on):
                yield going(on, *columns[1:6])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        size, most = 0, block_bytes

        def joined() -> list:
            return [sum(c, []) if k == 5 else np.concatenate(c) for k, c in enumerate(zip(*held))]

        for batch in batches:
            known = batch.filter(batch.column(5).is_null())
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns[1:6], names)
                batch = batch.filter(batch.column(5).is_valid())
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 4)]
            held.append([*columns, batch.column(5).to_pylist(), batch.column(6).to_numpy(zero_copy_only=False)])
            size += int(columns[4].sum()) + (length - 1) * batch.num_rows
            if size >= most:
                columns = joined()
                cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last anchor may go on
                if cut:
                    yield from judged([c[:cut] for c in columns])
                columns = [c[cut:] for c in columns]
                if columns[6].all() and len(columns[0]) > 1:  # of one string only the earliest is still wanted
                    on = []
                    for found, rows in judge(*columns):
                        yield found
                        on.append(rows)
                    # Strings at one place are one.
                    on = np.concatenate(on)
                    on = on[np.unique(np.stack([columns[k][on] for k in (1, 2, 3)]), axis=1, return_index=True)[1]]
                    columns = [[columns[5][r] for r in on.tolist()] if k == 5 else c[on] for k, c in enumerate(columns)]
                held = [columns]
                size = int(columns[4].sum()) + (length - 1) * len(columns[5])
                most = max(block_bytes, 2 * size)
        if held:
            yield from judged(joined())

    return runs.repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "id bigint, hash bigint, low bigint, count bigint, bytes binary")


def _met_again(rows: DataFrame) -> DataFrame:
    """Late stretches, where at most one string a salt meets its equals; late ones only pass."""
    part = F.when(F.col("bytes").isNull(), F.xxhash64("id", "low")).otherwise(0)
    place = F.struct("id", "hash", "low")
    earliest = F.first(place).over(Window.partitionBy("bytes", "part").orderBy("id", "hash", "low"))
    return rows.withColumn("part", part).withColumn("late", F.col("bytes").isNull() | (place > earliest)).filter(
        "late").select("id", "hash", "low", "count")


def late_stretches(documents: DataFrame, length: int = LENGTH, hot_runs: int | None = None) -> DataFrame:
    """(id, hash, low, count) of all strings of ``length`` bytes that also start earlier."""
    met = written(_met(_listed(documents, length)))
    waiting = met.filter(F.col("kind") < KIND_LATE).drop("kind")
    at_once = met.filter(F.col("kind") == KIND_LATE).select("id", "hash", "low", "count")
    rows, singles = _with_bytes(documents, waiting, length, hot_runs)
    late = _late(rows, length)
    return at_once.union(_met_again(late) if singles else late.drop("bytes"))


def cut_repeats(
    df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_runs: int | None = None,
    carry: bool = False,
) -> DataFrame:
    """(id, n_bytes, removed, kept) of every row, and with ``carry`` its text and the rest of the row.

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document
    of smaller id, or earlier in the same one.  ``removed`` are the maximal runs cut out, as
    (start, end) byte positions, ``kept`` the other bytes.  ``text`` is ``kept`` as characters, where
    what is left of a character cut in two goes as well; ``row`` has the other columns.  Null texts count as empty and texts
    shorter than ``length`` are kept; ids must be whole numbers, null ids come last, rows of one id
    are in order of a hash of their content, and rows equal in both are one document.
    """
    rest = [F.struct(*[df[c] for c in df.columns if c != text_col]).alias("row")] if carry else []
    numbers = df.agg(F.count(F.lit(1)), F.count_distinct(df[id_col].cast("long"))).first()
    unique = numbers[0] == numbers[1]  # then ids alone tell documents apart
    documents = _documents(df, id_col, text_col, unique)
    stretches = late_stretches(documents, length, hot_runs).groupBy("id", "hash").agg(
        F.collect_list(F.struct("low", "count")).alias("late"))
    more = ["own_id", *(["row"] if carry else [])]
    whole = _packed(_documents(df, id_col, text_col, unique, df[id_col].alias("own_id"), *rest), *more)
    rows = whole.join(stretches, ["id", "hash"], "left").select("own_id", "packed", "late", *more[1:])
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data, offsets = utf8(_unpacked(part.column(1)))
                sizes, spans, kept = [], [], []
                for i, late in enumerate(part.column(2).to_pylist()):
                    own = data[offsets[i]:offsets[i + 1]]
                    sizes.append(len(own))
                    if not late:
                        spans.append([])
                        kept.append(own.tobytes())
                        continue
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, [x["low"] for x in late], 1)
                    np.add.at(edge, [x["low"] + x["count"] + length - 1 for x in late], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
                    kept.append(own[~gone].tobytes())
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()),
                     *([pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())] if carry else []),
                     *part.columns[3:]], ["own_id", "n_bytes", "removed", "kept", *(["text", "row"] if carry else [])])

    tail = f", text string, row {rows.schema['row'].dataType.simpleString()}" if carry else ""
    return rows.mapInArrow(
        run, f"own_id {kind}, n_bytes bigint, removed array<struct<start:bigint,end:bigint>>, kept binary{tail}"
    ).withColumnRenamed("own_id", id_col)
