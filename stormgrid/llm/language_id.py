"""Language identification with a string kernel.

The kernel of two texts is the number of byte n-grams (blended spectrum, orders 1 to 4) present in
both, divided by the geometric mean of their own numbers.  Ridge regression, one language against
the rest, runs on Nyström features: kernels with landmark texts, whitened by the landmarks' own
kernel matrix.  Scoring is two matrix products a batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid.llm.texts import slices, strings

UNDETERMINED = "und"
ORDERS = (1, 2, 3, 4)
#: n-grams the kernel counts, and slots they are hashed to before those are chosen.
GRAMS = 4096
SLOT_BITS = 18
LANDMARKS = 128
#: The fit reads at most so many texts of a language, so many in all, each of at most so many characters.
FIT_PER_LANGUAGE = 300
FIT_ROWS = 6_000
FIT_CHARS = 20_000
#: Languages that can be learned, the most frequent ones.
FIT_LANGUAGES = 200
RIDGE = 1e-2
#: A language's own n-grams are in so large a share of its texts; the orders that tell; n-grams taken as own beforehand.
OWN_SHARE = 0.01
OWN_ORDERS = (2, 3, 4)
OWN_BEFORE = 10
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes whose n-grams are looked up at a time.
SPAN = 1 << 20


def gram_slots(data: np.ndarray, orders: tuple[int, ...] = ORDERS) -> Iterator[np.ndarray]:
    """Slots of the n-grams of one text, span by span."""
    for at in range(0, len(data), SPAN):
        part = _LOWER[data[at:at + SPAN + max(ORDERS) - 1]].astype(np.uint64)
        code = np.zeros(len(part), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(part) < n:
                break
            code = (code[:len(part) - n + 1] << np.uint64(8)) | part[n - 1:]
            if n in orders:
                mixed = (code + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed[:SPAN] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


@dataclass
class Model:
    """Everything a prediction needs; its size does not depend on the corpus."""

    languages: list[str]
    column_of: np.ndarray  # slot -> column of the presence matrix, or the last, unused one
    landmarks: np.ndarray  # n-grams x landmarks, normalised presence
    weights: np.ndarray  # landmarks x languages
    own: np.ndarray  # languages x slots, as bits: the language's own n-grams

    def presence(self, texts: list[str]) -> np.ndarray:
        """Rows of n-grams present, each of length 1."""
        out = np.zeros((len(texts), self.landmarks.shape[0] + 1), np.float32)
        for row, text in zip(out, texts):
            for slots in gram_slots(_bytes(text)):
                row[self.column_of[slots]] = 1
        out = out[:, :-1]
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; 0.5 says that the languages were not told apart."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        kernels = self.presence(texts) @ self.landmarks
        values = kernels @ self.weights
        best = values.argmax(axis=1)
        score = np.clip((values[np.arange(len(texts)), best].astype(np.float64) + 1) / 2, 0, 1)
        none = np.array([not _LETTER.search(t) for t in texts], bool)
        names = [UNDETERMINED if n else self.languages[b] for b, n in zip(best, none)]
        return names, np.where(none, 0.0, score)


    def known(self, texts: list[str], names: list[str]) -> np.ndarray:
        """Share of each text's n-grams that the named language has itself; 0 where it is ``und``.

        The values of ``predict`` compare languages and say nothing about a text in none of them.
        A few n-grams count as own beforehand, so that one rare word is not enough to reject a text.
        """
        out = np.zeros(len(texts))
        row = {k: i for i, k in enumerate(self.languages)}
        for i, (text, name) in enumerate(zip(texts, names)):
            if name == UNDETERMINED:
                continue
            own, n, found = self.own[row[name]], 0, 0
            for slots in gram_slots(_bytes(text), OWN_ORDERS):
                n += len(slots)
                found += int(np.count_nonzero((own[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1))
            out[i] = (found + OWN_BEFORE) / (n + OWN_BEFORE)
        return out


def fit(texts: list[str], languages: list[str], grams: int = GRAMS, landmarks: int = LANDMARKS,
        ridge: float = RIDGE) -> Model:
    """Train on texts in a fixed order; no text gives a model that answers ``und``."""
    names = sorted(set(languages))
    # Only the slots a text has are held; whole columns are made for the chosen ones.
    slots_of = [np.unique(np.concatenate([np.zeros(0, np.int64), *gram_slots(_bytes(text))])) for text in texts]
    counts = {k: np.zeros(1 << SLOT_BITS, np.int32) for k in names}
    for slots, k in zip(slots_of, languages):
        counts[k][slots] += 1
    # The n-grams whose share of texts differs most between languages.
    known = np.array(languages, dtype=object)
    sizes = {k: np.count_nonzero(known == k) for k in names}
    most, least = np.zeros(1 << SLOT_BITS), np.full(1 << SLOT_BITS, np.inf)
    for k in names:
        share = counts[k] / sizes[k]
        np.maximum(most, share, out=most)
        np.minimum(least, share, out=least)
    spread = most - least if len(names) > 1 else most
    chosen = np.sort(np.argsort(-spread, kind="stable")[:grams])
    column_of = np.full(1 << SLOT_BITS, len(chosen), np.int32)
    column_of[chosen] = np.arange(len(chosen))
    x = np.zeros((len(texts), len(chosen) + 1), np.float32)  # the last column takes the slots not chosen
    for row, slots in zip(x, slots_of):
        row[column_of[slots]] = 1
    x = x[:, :-1]
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    # Landmarks in turn from each language, so that all are represented.
    turn = {k: 0 for k in names}
    order = []
    for i, k in enumerate(languages):
        order.append((turn[k], i))
        turn[k] += 1
    marks = [i for _, i in sorted(order)[:landmarks]]
    z = x[marks].T.astype(np.float32)
    if not names:
        return Model([], column_of, z, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.uint8))
    has = np.array([np.packbits(counts[k] >= max(1, OWN_SHARE * sizes[k])) for k in names])
    own = (x[marks] @ z).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = (x @ z).astype(np.float64) @ whiten
    target = np.where(known[:, None] == np.array(names, dtype=object)[None, :], 1.0, -1.0)
    balance = np.array([1.0 / np.count_nonzero(known == k) for k in languages]) * len(texts) / len(names)
    gram = (features * balance[:, None]).T @ features
    beta = np.linalg.solve(gram + ridge * len(texts) * np.eye(len(gram)) / len(gram), (features * balance[:, None]).T @ target)
    return Model(names, column_of, z, (whiten @ beta).astype(np.float32), has)


def fit_sample(
    df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = FIT_PER_LANGUAGE, rows: int = FIT_ROWS, chars: int = FIT_CHARS,
) -> DataFrame:
    """The labelled rows a fit reads: of each language those first in a hashed order."""
    usable = df.filter(
        learn & F.col(lang_col).isNotNull() & (F.char_length(text_col) <= chars)
        & F.col(text_col).rlike(r"\p{L}")
    ).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
             F.xxhash64(id_col, text_col).alias("at"))
    # Per language about four times as many as wanted pass a threshold, so that what tasks send on
    # does not grow with their number.
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(FIT_LANGUAGES).collect()
    limit = F.lit(0)
    for row in counts:
        share = min(1.0, 4 * per_language / row["count"])
        limit = F.when(F.col("lang") == row["lang"], F.lit(int(share * (1 << 40)))).otherwise(limit)
    usable = usable.filter(F.pmod("at", F.lit(1 << 40)) < limit)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    return usable.withColumn("nth", nth).filter(F.col("nth") <= per_language).orderBy("nth", "at", "lang").limit(rows)


def identify(
    df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    carry: bool = False,
) -> DataFrame:
    """(id, lang_pred, score) of every row, and with ``carry`` also ``text``, ``row`` and ``known``.

    The model is fitted on rows where ``learn`` holds and the language is known; only the text
    goes into a prediction.  A null text or one without a letter is ``und`` with score 0, as is
    every text when there is nothing to learn from.  Ties go to the first language by name.
    ``known`` is the share of a text's n-grams that its predicted language has itself; ``row`` has
    the other columns of the input, so that a text travels once.
    """
    sample = fit_sample(df, learn, id_col, text_col, lang_col).collect()
    sample.sort(key=lambda r: (r["lang"], r["at"], r["text"]))
    model = df.sparkSession.sparkContext.broadcast(fit([r["text"] for r in sample], [r["lang"] for r in sample]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 256):
                texts = strings(part.column(1))
                names, score = model.value.predict(texts)
                more = [part.column(1), part.column(2), pa.array(model.value.known(texts, names))] if carry else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score), *more],
                    ["id", "lang_pred", "score", *(["text", "row", "known"] if carry else [])],
                )

    rows = df.select(
        df[id_col].alias("id"), df[text_col].cast("string").alias("text"),
        *([F.struct(*[df[c] for c in df.columns if c != text_col]).alias("row")] if carry else []),
    )
    kind = df.schema[id_col].dataType.simpleString()
    tail = f", text string, row {rows.schema['row'].dataType.simpleString()}, known double" if carry else ""
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double{tail}").withColumnRenamed("id", id_col)
