"""Near duplicates by SimHash fingerprints compared in bit-sliced form.

Fingerprints are cut into bands; two that differ in few bits agree on a band, so only rows of one
band value meet.  A bucket's fingerprints are stored as 64 bit planes, one machine word holding
the same bit of 64 fingerprints.  Shifting the planes by d rows lays every fingerprint beside its
d-th neighbour; differences are summed by full adders on whole words, and a block is abandoned
once all its pairs exceed the radius.  Each bucket gives at most one link a row.  Buckets above a
bound are cut finer by the bits not used yet, and what is still large is compared block by block,
so no pair is lost and no task holds an unbounded bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.texts import slices, utf8
from stormgrid.session import materialize

BUCKET_ROWS = 2048
#: Rows whose bit planes are compared at a time.
LANES = 1 << 16

# Byte -> its bits spread to eight 8-bit counters in one word.
_SPREAD = np.array(
    [sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64
)


def _majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per group of hashes the word of bits set in more than half of them (empty group: 0)."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    blocks = -(-counts[some] // 255)
    first_block = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    within = np.arange(blocks.sum()) - np.repeat(first_block, blocks)
    at = np.repeat(starts[some], blocks) + 255 * within
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, k]], at)
        bits = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first_block)
        on = 2 * bits > counts[some][:, None]
        out[some] |= np.packbits(on, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def fingerprint_batch(texts: list[bytes], width: int = 3, seed: int = 42) -> np.ndarray:
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
        if not words:
            continue
        joined = b" ".join(words)
        n = max(1, len(words) - width + 1)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
        ends = ends[-n:].tolist()
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts, ends)]
        counts[i] = n
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    return _majority(np.array(hashes, np.uint64), starts, counts)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit number.

    Null and white-space texts have fingerprint 0; a text of fewer words than a shingle is one
    shingle.  Every other column is left out.
    """
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, at = utf8(part.column(1))
                held = data.tobytes()
                fp = fingerprint_batch([held[a:b] for a, b in zip(at[:-1], at[1:])])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, fp bigint")


# ---------------------------------------------------------------------------
# Comparison
# ---------------------------------------------------------------------------
def bit_planes(words: np.ndarray) -> np.ndarray:
    """(64, n / 64 rounded up, and one more) words: row b holds bit b of all numbers."""
    n = len(words)
    bits = np.unpackbits(words.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes = np.zeros((64, (n + 63) // 64 * 8 + 8), np.uint8)
    planes[:, :packed.shape[1]] = packed
    return planes.view(np.uint64)


def pairs_at(planes: np.ndarray, lanes: int, shift: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Rows i < lanes with ``valid`` whose number differs from row i + shift in at most radius bits."""
    words = (lanes + 63) // 64
    skip, bit = divmod(shift, 64)
    alive = np.zeros(words * 8, np.uint8)
    alive[:(lanes + 7) // 8] = np.packbits(valid, bitorder="little")
    alive = alive.view(np.uint64)
    size = radius.bit_length()
    counters = np.zeros((size, words), np.uint64)
    over = np.zeros(words, np.uint64)

    def difference(b: int) -> np.ndarray:
        here, there = planes[b, :words], planes[b, skip:skip + words + 1]
        if len(there) < words + 1:
            there = np.concatenate([there, np.zeros(words + 1 - len(there), np.uint64)])
        if bit:
            return here ^ ((there[:words] >> np.uint64(bit)) | (there[1:] << np.uint64(64 - bit)))
        return here ^ there[:words]

    for b in range(0, 64, 2):
        x, y = difference(b), difference(b + 1)
        either = x ^ y
        carry = (x & y) | (counters[0] & either)  # full adder: two planes and the ones
        counters[0] ^= either
        for k in range(1, size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 6 and not (alive & ~over).any():
            return np.zeros(0, np.int64)
    alive = alive & ~over
    if radius != (1 << size) - 1:  # counters hold the distance; compare it with the radius
        equal, below = np.full(words, ~np.uint64(0)), np.zeros(words, np.uint64)
        for k in reversed(range(size)):
            if radius >> k & 1:
                below |= equal & ~counters[k]
                equal &= counters[k]
            else:
                equal &= ~counters[k]
        alive &= below | equal
    return np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little")[:lanes])


def bucket_links(keys: np.ndarray, fps: np.ndarray, radius: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows of equal key within the radius, at most one a row."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 1]
    starts, sizes = starts[by_size], sizes[by_size]
    if not len(sizes):
        return fps[:0], fps[:0]
    n = int(sizes.sum())
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    lane_fps = fps[np.arange(n) - first[bucket] + starts[bucket]].view(np.uint64)
    planes = bit_planes(lane_fps)
    left = sizes[bucket] - (np.arange(n) - first[bucket]) - 1  # neighbours after a row
    up = np.arange(n)
    links = []

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for shift in range(1, int(sizes[0])):
        lanes = int(sizes[:np.searchsorted(-sizes, -shift)].sum())
        near = pairs_at(planes, lanes, shift, left[:lanes] >= shift, radius)
        near = near[up[near] != up[near + shift]] if len(near) else near
        for i in near.tolist():
            a, b = top(i), top(i + shift)
            if a != b:
                up[max(a, b)] = min(a, b)
                links.append((i, i + shift))
        if len(near):
            while (up[up] != up).any():
                up = up[up]
    if not links:
        return fps[:0], fps[:0]
    a, b = np.array(links).T
    signed = lane_fps.view(np.int64)
    return signed[a], signed[b]


def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _cut(df: DataFrame, width: int, path: Column, radius: int) -> DataFrame:
    """(fp, rest, path, key): for every band of the ``width`` bits in ``rest``, one row.

    ``rest`` are the bits outside the bands chosen so far, ``path`` which those were.
    """
    bands = radius + 1
    step = width // bands
    found = []
    for k in range(bands):
        size = step if k < bands - 1 else width - step * (bands - 1)
        low, high = k * step, k * step + size
        above = _bits(F.col("rest"), high, width - high) if high < width else F.lit(0)
        below = _bits(F.col("rest"), 0, low) if low else F.lit(0)
        found.append(F.struct(
            F.shiftleft(above.cast("long"), low).bitwiseOR(below.cast("long")).alias("rest"),
            (path * bands + k).alias("path"),
            F.xxhash64(F.col("key"), F.lit(k), _bits(F.col("rest"), low, size)).alias("key"),
        ))
    return df.select("fp", F.inline(F.array(*found)))


def _compared(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside the buckets ``key`` of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = [], []
        held = 0
        for batch in batches:
            keys.append(batch.column(0).to_numpy())
            fps.append(batch.column(1).to_numpy())
            held += batch.num_rows
            if held >= LANES:
                k, f = np.concatenate(keys), np.concatenate(fps)
                cut = int(np.searchsorted(k, k[-1]))  # the last bucket may go on
                if cut:
                    yield links(k[:cut], f[:cut])
                keys, fps, held = [k[cut:]], [f[cut:]], len(k) - cut
        if held:
            yield links(np.concatenate(keys), np.concatenate(fps))

    def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        u, v = bucket_links(k, f, radius)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    by_key = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return by_key.mapInArrow(run, "u bigint, v bigint")


def fingerprint_links(
    nodes: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(u, v) links whose components are those of all fingerprints within the radius.

    ``nodes`` has one row per distinct ``fp``.  Three rounds of bands use up to 64, 48 and 36
    bits; a bucket that is still above ``bucket_rows`` is cut into blocks by hash and every two
    blocks meet in a task of their own.
    """
    rows = nodes.select(
        "fp", F.col("fp").alias("rest"), F.lit(0).cast("int").alias("path"), F.lit(0).cast("long").alias("key")
    )
    width, out = 64, []
    for last in (False, False, True):
        rows = _cut(rows, width, F.col("path"), radius)
        width -= width // (radius + 1)
        large = materialize(
            rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows)
        )
        if large.isEmpty():
            out.append(_compared(rows, radius))
            break
        out.append(_compared(rows.join(large, "key", "left_anti"), radius))
        rows = rows.join(large, "key")
        if last:
            blocks = F.ceil(2 * F.col("n") / bucket_rows).cast("int")
            mine = F.pmod(F.xxhash64("fp", F.lit(1)), blocks).cast("int")
            other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
            pairs = rows.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", other)
            out.append(_compared(pairs.select(
                "fp", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key")
            ), radius))
        else:
            rows = materialize(rows.select("fp", "rest", "path", "key"))
    links = out[0]
    for more in out[1:]:
        links = links.union(more)
    return links


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every node of (u, v) links: connected components by contraction.

    In each round every node hooks to the neighbour first in a hashed order (changed every
    round) and the graph shrinks by that mapping; rounds grow with the logarithm of a
    component's width.  Links live in written tables only, nothing is collected.
    """
    steps: list[DataFrame] = []
    links = materialize(links.filter("u <> v").distinct())
    while not links.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))), F.col(c))  # noqa: B023, E731
        both = links.select("u", "v").union(links.select("v", "u"))
        best = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
        hooks = materialize(best.select(
            "u", F.when(F.col("best") < rank("u"), F.col("best.v")).otherwise(F.col("u")).alias("to")
        ))
        steps.append(hooks)
        links = materialize(
            links.join(hooks, "u").select(F.col("to").alias("a"), F.col("v").alias("u"))
            .join(hooks, "u").select(F.col("a").alias("u"), F.col("to").alias("v"))
            .filter("u <> v").distinct()
        )
    if not steps:
        return links.select("u", F.col("v").alias("root"))
    out = steps[0].withColumnRenamed("to", "root")
    for hooks in steps[1:]:
        out = out.join(hooks.select(F.col("u").alias("root"), "to"), "root", "left").select(
            "u", F.coalesce("to", "root").alias("root")
        )
    return out


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id reachable over links of close fingerprints.

    Equal fingerprints are one node, so copies cost nothing.  Null ids take part and get the
    component of their fingerprint, whose id is null if it has no other.
    """
    fps = materialize(fingerprints(df, id_col, text_col))
    nodes = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")))
    of_node = components(fingerprint_links(nodes, radius, bucket_rows)).select(F.col("u").alias("fp"), "root")
    linked = materialize(nodes.join(of_node, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(linked.join(least, "root").select("fp", "component_id"))
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3) -> DataFrame:
    """One row of each component, that of the smallest id, with all its columns.

    Null ids come last; rows of one id are in order of a hash of all columns, and rows equal in
    every column are one row.
    """
    last = F.when(df[id_col].isNull(), 1).otherwise(0)
    key = F.struct(last.alias("last"), df[id_col].alias("id"), F.xxhash64(*[df[c] for c in df.columns]).alias("tie"))
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), key.alias("key"), df[text_col].alias("text"))
    groups = near_groups(rows, "key", "text", radius)
    first = groups.filter(F.col("key") == F.col("component_id")).select("component_id")
    met = rows.select("row", "key").join(first, F.col("key").eqNullSafe(F.col("component_id")), "left_semi")
    return met.dropDuplicates(["key"]).select("row.*")
