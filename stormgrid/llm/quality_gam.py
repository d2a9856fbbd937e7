"""Quality classification by a generalised additive model with pairwise interactions.

The log-odds are a sum of one lookup table a feature and one a pair of features.  Tables are
learned by cyclic boosting: round after round each feature in turn gets a shallow tree fitted to
what the sum leaves over, and the tree's leaf values are added to its table.  Scoring finds the bin
of each feature and adds table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stormgrid.llm.text_counts import basic_counts, class_counts
from stormgrid.llm.texts import hashed_sample, slices, strings
from stormgrid.session import materialize

FEATURES = (
    "words", "word_length", "lower", "upper", "digit", "space", "stop", "symbol", "other", "beyond_ascii",
    "duplicate_lines", "repeated_words", "distinct_words", "line_words", "longest_word", "capital_words",
    "marked_words", "bars", "short_lines",
)
BINS = 32
ROUNDS = 150
RATE = 0.1
PAIRS = 8
PAIR_BINS = 8
#: Labelled rows the fit reads at most.
FIT_ROWS = 20_000


def features(text: str) -> list[float]:
    words, (n, word_chars, _, dup, repeated) = basic_counts(text)
    chars = max(1, len(text))
    lines = [line.split() for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    some = max(1, n)
    ends = [w[-1:] for w in words]
    return [
        float(np.log1p(n)), word_chars / some, *(class_counts(text) / chars), dup / n_lines, repeated / some,
        len(set(words)) / some, float(np.log1p(n / n_lines)), float(np.log1p(max(map(len, words), default=0))),
        sum(w.isupper() for w in words) / some,
        sum(not e.isalnum() and e < b"\x80" and e not in (b".", b",") for e in ends) / some,
        words.count(b"|") / some, sum(len(line) <= 2 for line in lines) / n_lines,
    ]


def feature_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the features of every row in the order of ``FEATURES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = list(map(features, strings(part.column(1))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, x array<double>")


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3, least: float = 1.0) -> np.ndarray:
    """Leaf value of every bin of a tree with up to so many leaves, by Newton gains."""
    cuts = [0, len(gradient)]
    g, w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    for _ in range(leaves - 1):
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gl, wl, gr, wr = g[k] - g[a], w[k] - w[a], g[b] - g[k], w[b] - w[k]
            gain = gl**2 / (wl + least) + gr**2 / (wr + least) - (g[b] - g[a])**2 / (w[b] - w[a] + least)
            i = int(gain.argmax())
            if gain[i] > best:
                best, at = gain[i], int(k[i])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.empty(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + least)
    return out


def _cross(gradient: np.ndarray, weight: np.ndarray, least: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best two cuts, one on each axis."""
    def total(x: np.ndarray) -> np.ndarray:
        out = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        out[1:, 1:] = x.cumsum(0).cumsum(1)
        return out

    g, w = total(gradient), total(weight)
    corner = lambda t: (t[1:-1, 1:-1], t[1:-1, -1:] - t[1:-1, 1:-1], t[-1:, 1:-1] - t[1:-1, 1:-1],
                        t[-1, -1] - t[1:-1, -1:] - t[-1:, 1:-1] + t[1:-1, 1:-1])
    gain = sum(a**2 / (b + least) for a, b in zip(corner(g), corner(w)))
    if not gain.size:
        return 0.0, np.zeros_like(gradient)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(gradient)
    a, b = i + 1, j + 1
    for rows, columns in ((slice(a), slice(b)), (slice(a), slice(b, None)), (slice(a, None), slice(b)), (slice(a, None), slice(b, None))):
        out[rows, columns] = gradient[rows, columns].sum() / (weight[rows, columns].sum() + least)
    return float(gain[i, j]), out


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            bins = self.bins(x)
            for k, table in enumerate(self.tables):
                total += table[bins[:, k]]
            for i, j, table in self.pairs:
                total += table[bins[:, i] * PAIR_BINS // BINS, bins[:, j] * PAIR_BINS // BINS]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Model:
    """Learn the tables; without rows, or with one label only, the score is a constant."""
    model = Model()
    n = len(y)
    positives = float(y.sum()) if n else 0.0
    model.base = float(np.log((positives + 1) / (n - positives + 1)))
    if not n or positives in (0.0, float(n)):
        return model
    model.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    bins = model.bins(x)
    model.tables = [np.zeros(BINS) for _ in model.edges]
    total = np.full(n, model.base)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            gradient, weight = rest()
            step = rate * _tree(np.bincount(bins[:, k], gradient, BINS), np.bincount(bins[:, k], weight, BINS))
            table += step
            total += step[bins[:, k]]
    coarse = bins * PAIR_BINS // BINS
    gradient, weight = rest()

    def cells(i: int, j: int, values: np.ndarray) -> np.ndarray:
        at = coarse[:, i] * PAIR_BINS + coarse[:, j]
        return np.bincount(at, values, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    found = [(_cross(cells(i, j, gradient), cells(i, j, weight))[0], i, j)
             for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in sorted(found, reverse=True)[:pairs]]
    for _ in range(rounds // 2):
        for i, j, table in model.pairs:
            gradient, weight = rest()
            step = rate * _cross(cells(i, j, gradient), cells(i, j, weight))[1]
            table += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def quality_scores(
    df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(id, score) of every row: the probability that its label would be 1.

    The model is fitted on labelled rows where ``learn`` (a column over the id) holds, at most
    ``fit_rows``, chosen by a hash of the id; an id labelled more than once counts with its largest
    label.  A prediction uses the text only.  Empty and null texts have a score like any other;
    without usable labels every score is the same.
    """
    rows = materialize(feature_rows(df, id_col, text_col))
    marked = labels.filter(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(label_col).cast("double").alias("y"))
    usable = rows.join(marked, "id").select("id", "x", "y")
    sample = sorted(hashed_sample(usable, F.xxhash64("id", "x"), fit_rows).select("x", "y").collect())
    x = np.array([r["x"] for r in sample], float).reshape(len(sample), len(FEATURES))
    model = df.sparkSession.sparkContext.broadcast(fit(x, np.array([r["y"] for r in sample], float)))
    kind = to_arrow_type(df.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(kind), pa.array(model.value.score(x))], ["id", "score"])

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
