"""Class-weighted logistic regression by Newton steps.

A step is one pass: every task adds up its share of the Gram matrix and the gradient, the shares
are summed by Spark, and the driver solves a system of as many equations as the model has columns.
The optimum is reached to the last digits in a handful of passes, which makes scores comparable
between engines; a model too wide for a square matrix is for ``model.fit``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.operators.model import category_index, class_weights, scaling
from stormgrid.operators.scale import lookup_join
from stormgrid.session import materialize

#: Columns up to which the square matrix is summed; its half has some 33,000 numbers then.
MAX_COLUMNS = 256
MAX_STEPS = 50


@dataclass
class NewtonModel:
    """Coefficients on scaled columns, and a table (value, effect) per category."""

    intercept: float
    slopes: dict[str, float]
    scaled: dict[str, tuple[float, float]]
    effects: dict[str, DataFrame]
    steps: int
    coefficients: np.ndarray = field(repr=False)

    def transform(self, df: DataFrame, out: str = "p") -> DataFrame:
        """``df`` with the probability of class 1; a category not met in training has no effect."""
        columns = df.columns
        odds = F.lit(self.intercept)
        for c, slope in self.slopes.items():
            mean, std = self.scaled[c]
            odds = odds + F.lit(slope) * ((F.col(c).cast("double") - F.lit(mean)) / F.lit(std))
        for c, effects in self.effects.items():
            df = lookup_join(df, effects.withColumnRenamed("effect", f"{c}__e"), [c], "left")
            odds = odds + F.coalesce(F.col(f"{c}__e"), F.lit(0.0))
        return df.select(*columns, (1 / (1 + F.exp(-odds))).alias(out))


def one_class(positive: bool) -> NewtonModel:
    """The model of rows that all have one label: the intercept grows without end, the probability is 1 or 0."""
    limit = np.inf if positive else -np.inf
    return NewtonModel(float(limit), {}, {}, {}, 0, np.array([limit]))


def _rows(
    train: DataFrame, numeric: Sequence[str], scaled: dict, indexes: dict[str, DataFrame], sizes: dict[str, int],
    label: str, weight: Column,
) -> DataFrame:
    """(x, at, y, weight): scaled numbers, positions of the row's categories, label; written once."""
    df, first, places = train, 0, []
    for c, index in indexes.items():
        df = lookup_join(df, index.withColumnRenamed("n", f"{c}__n"), [c], "left")
        places.append(F.coalesce(F.col(f"{c}__n").cast("int") + first, F.lit(-1)))
        first += sizes[c]
    x = [(F.col(c).cast("double") - F.lit(scaled[c][0])) / F.lit(scaled[c][1]) for c in numeric]
    return materialize(df.select(
        F.array(*x).cast("array<double>").alias("x"), F.array(*places).cast("array<int>").alias("at"),
        F.col(label).cast("double").alias("y"), weight.cast("double").alias("weight")))


def _sums(rows: DataFrame, beta: np.ndarray, hot: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix, gradient and loss of the weighted rows at ``beta``."""
    size = len(beta)
    upper = np.triu_indices(size)

    # Nested functions travel with the job, so executors need no copy of the package.
    def designed(batch: pa.RecordBatch) -> np.ndarray:
        """One, categories, numbers: a row of the design per row of the batch."""
        n = batch.num_rows
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        at = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        out = np.zeros((n, size))
        out[:, 0] = 1
        for column in at.T:
            known = np.flatnonzero(column >= 0)
            out[known, 1 + column[known]] = 1
        out[:, 1 + hot:] = x
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]) + size + 1)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                design = designed(part)
                y, weight = (part.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
                odds = design @ beta
                p = 1 / (1 + np.exp(-odds))
                gram = design.T @ (design * (weight * p * (1 - p))[:, None])
                loss = (weight * (np.logaddexp(0, odds) - y * odds)).sum()
                total += np.concatenate([gram[upper], design.T @ (weight * (y - p)), [loss]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "v"])

    summed = rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(len(upper[0]) + size + 1)
    for r in summed:
        total[r["at"]] = r["v"]
    gram = np.zeros((size, size))
    gram[upper] = total[:len(upper[0])]
    return gram + np.triu(gram, 1).T, total[len(upper[0]):-1], total[-1]


def fit_newton(
    train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str = D.LABEL, tol: float = 1e-11,
) -> NewtonModel:
    """One-hot + population scaling + L2 logistic regression with balanced classes, as ``model.fit``.

    The penalty is one half of the squared coefficients against the summed weighted loss; the
    intercept is free.  A step that makes the objective larger is halved.  Raises ValueError for a
    label of one class, a missing number, or a model of more than ``MAX_COLUMNS`` columns.
    """
    categorical, numeric = list(categorical), list(numeric)
    counts = {r[label]: r["n"] for r in class_weights(train, label).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"label {label} needs both classes, found {sorted(counts)}")
    known = train.dropna(subset=[label])
    missing = known.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in numeric]).first()
    if numeric and any(missing):
        raise ValueError(f"missing numbers in {[c for c in numeric if missing[c]]}")
    n = sum(counts.values())
    weight = F.when(F.col(label) == 1, n / (2 * counts[1])).otherwise(n / (2 * counts[0]))
    indexes = {c: category_index(known, c) for c in categorical}
    sizes = {c: index.count() for c, index in indexes.items()}
    hot = sum(sizes.values())
    size = 1 + hot + len(numeric)
    if size > MAX_COLUMNS:
        raise ValueError(f"{size} columns, at most {MAX_COLUMNS} for a square matrix")
    scaled = scaling(known, numeric)
    rows = _rows(known, numeric, scaled, indexes, sizes, label, weight)
    penalty = np.ones(size)
    penalty[0] = 0
    beta, step, before, steps = np.zeros(size), np.zeros(size), np.inf, 0
    while steps < MAX_STEPS:
        gram, gradient, loss = _sums(rows, beta, hot)
        steps += 1
        objective = loss + (penalty * beta * beta).sum() / 2
        if objective > before + 1e-9 * abs(before) and np.abs(step).max() > tol:
            step = step / 2
            beta = beta - step
            continue
        if steps > 1 and np.abs(step).max() <= tol:
            break
        before = objective
        step = np.linalg.solve(gram + np.diag(penalty), gradient - penalty * beta)
        beta = beta + step
    first, effects = 1, {}
    spark = train.sparkSession
    for c in categorical:
        own = beta[first:first + sizes[c]]
        numbered = spark.createDataFrame([(i, float(b)) for i, b in enumerate(own)], "n long, effect double")
        effects[c] = materialize(indexes[c].withColumn("n", F.col("n").cast("long")).join(numbered, "n").select(c, "effect"))
        first += sizes[c]
    slopes = dict(zip(numeric, beta[first:].tolist()))
    return NewtonModel(float(beta[0]), slopes, scaled, effects, steps, beta)
