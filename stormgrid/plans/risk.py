"""Train, tune, evaluate and score; then the serving tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.operators.cube import dim_region, dim_time, fact_risk
from stormgrid.operators.metrics import best_threshold, evaluate_scores
from stormgrid.operators.model import FittedModel, fit, positive_probability, score, select_features
from stormgrid.operators.newton import MAX_COLUMNS, NewtonModel, fit_newton, one_class
from stormgrid.operators.series import time_split
from stormgrid.session import materialize
from stormgrid.sources.tables import write_table


@dataclass
class RiskRun:
    """What one training run gives; the frames are lazy."""

    model: FittedModel | NewtonModel
    threshold: float
    f1: float
    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame
    auc: DataFrame
    predictions: DataFrame
    train: DataFrame
    test: DataFrame


def train_and_score(
    features: DataFrame,
    label: str = D.LABEL,
    fraction: float = D.TRAIN_FRACTION,
    tune_on: str = "test",
    ordered: bool = True,
    solver: str = "newton",
) -> RiskRun:
    """Chronological split, fit on the early part, threshold, metrics, all rows scored.

    ``solver`` is "newton" (a few exact passes; a model of more columns than ``MAX_COLUMNS`` takes the
    other way by itself) or "lbfgs" (Spark ML).  Both minimise the same objective.  Where the early part
    has rows of one class only, every row gets that class for certain, to which the objective tends.

    The threshold is tuned on the later part by default, and the score table also
    covers the training rows, so its figures are optimistic; ``tune_on="train"``
    keeps the later part untouched.
    """
    if tune_on not in ("train", "test"):
        raise ValueError("tune_on must be 'train' or 'test'")
    if solver not in ("newton", "lbfgs"):
        raise ValueError("solver must be 'newton' or 'lbfgs'")
    frame = materialize(features)
    categorical, numeric = select_features(frame)
    train, test = time_split(frame, "fecha", ["alcaldia"], fraction)
    model = _fitted(train, categorical, numeric, label, solver)
    held_out = positive_probability(model, test).select(label, "p")
    chosen = None
    if tune_on == "train":
        chosen = best_threshold(positive_probability(model, train), label, "p").first()
    found = evaluate_scores(held_out, label, "p", chosen and chosen["threshold"])
    return RiskRun(
        model=model,
        threshold=found.threshold,
        f1=chosen["f1"] if chosen else found.f1,
        metrics=found.metrics,
        confusion=found.confusion,
        report=found.report,
        auc=found.auc,
        predictions=score(model, frame, found.threshold, label=label, ordered=ordered),
        train=train,
        test=test,
    )


def _fitted(train, categorical, numeric, label: str, solver: str) -> FittedModel | NewtonModel:
    classes = [r[label] for r in train.select(label).dropna().distinct().limit(3).collect()]
    if classes in ([0], [1]):
        return one_class(classes == [1])
    if solver == "newton":
        values = [F.approx_count_distinct(c).alias(c) for c in categorical]
        columns = sum(train.agg(*values).first()) if values else 0
        # The sketch may be a few per cent off: stay clear of the limit.
        if 1 + len(numeric) + 1.2 * columns <= MAX_COLUMNS:
            return fit_newton(train, categorical, numeric, label)
    return fit(train, categorical, numeric, label)


def write_cube(predictions: DataFrame, path: str, order_col: str | Sequence[str]) -> None:
    """Write ``dim_time``, ``dim_region`` and the fact, partitioned by day, under ``path``.

    ``order_col`` says which row of a day and region is the latest; where rows tie
    in it there is no latest one.
    """
    fact = fact_risk(predictions, order_col)
    write_table(dim_time(predictions), f"{path}/dim_time")
    write_table(dim_region(predictions), f"{path}/dim_region")
    write_table(fact, f"{path}/fact_risk", partition_by=["fecha"])
