"""Evaluation of binary scores as aggregates; nothing here sorts the scored rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid import defaults as D
from stormgrid.operators.scale import SLICE_ROWS, ranged
from stormgrid.session import materialize


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _thresholds_reached(p: Column, start: float, step: float, count: int) -> Column:
    """How many of ``start + i * step`` (i < count) are at or below ``p``.

    The division finds the place up to rounding; comparing with the neighbours
    in the same arithmetic as the thresholds makes it exact.
    """
    delta = (start + step) - start
    guess = F.greatest(F.lit(0), F.least(F.lit(count), F.floor((p - start) / delta) + 1))

    def at(i: Column) -> Column:
        return F.lit(start) + i * F.lit(delta)

    return (
        F.when((guess < count) & (at(guess) <= p), guess + 1)
        .when((guess > 0) & (at(guess - 1) > p), guess - 1)
        .otherwise(guess)
    )


def score_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    """(p, pos, neg): positive and negative rows per score; rows without label or score are left out.

    Threshold, metrics, confusion, report and AUC of ``Evaluation`` all follow from this table.
    """
    return df.dropna(subset=[y, p]).groupBy(F.col(p).alias("p")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"),
    )


def best_threshold(
    df: DataFrame,
    y: str,
    p: str,
    thresholds: tuple[float, float, int] = (
        D.THRESHOLD_START, D.THRESHOLD_STEP, D.THRESHOLD_COUNT,
    ),
) -> DataFrame:
    """One row (threshold, f1): the lowest threshold with the highest F1.

    ``thresholds`` is (start, step, count).  Rows are counted by the number of
    thresholds they reach; the rest runs on at most ``count + 1`` rows.  If no
    threshold scores above zero the row is (0, 0).
    """
    start, step, count = thresholds
    bins = (
        df.dropna(subset=[y, p])
        .groupBy(_thresholds_reached(F.col(p), start, step, count).alias("bin"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    )
    return _best_of(bins, start, step)


def _best_of(bins: DataFrame, start: float, step: float) -> DataFrame:
    """The best threshold from rows counted by the number of thresholds they reach."""
    delta = (start + step) - start
    up = Window.orderBy("bin")
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    everything = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swept = bins.select(
        "bin",
        F.coalesce(F.lag("bin").over(up), F.lit(0)).alias("lowest"),
        F.sum("pos").over(down).alias("tp"),
        F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(everything).alias("positives"),
    ).filter("bin > 0")
    scored = swept.select(
        (F.lit(start) + F.col("lowest") * F.lit(delta)).alias("threshold"),
        _ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("positives")).alias("f1"),
    ).filter("f1 > 0")
    best = F.max_by(
        F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("threshold"))
    )
    return scored.agg(best.alias("b")).select(
        F.coalesce("b.threshold", F.lit(0.0)).alias("threshold"),
        F.coalesce("b.f1", F.lit(0.0)).alias("f1"),
    )


def _cells(df: DataFrame, y: str, pred: str) -> DataFrame:
    a, b = F.col(y), F.col(pred)
    return df.agg(
        F.count_if((a == 0) & (b == 0)).alias("tn"),
        F.count_if((a == 0) & (b == 1)).alias("fp"),
        F.count_if((a == 1) & (b == 0)).alias("fn"),
        F.count_if((a == 1) & (b == 1)).alias("tp"),
    )


def binary_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1 (0 where a denominator is 0)."""
    return _metrics_of(_cells(df, y, pred))


def _metrics_of(cells: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Four rows (actual, predicted, n), empty cells included."""
    return _confusion_of(_cells(df, y, pred))


def _confusion_of(counts: DataFrame) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n"))
        for a, b, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    ])
    return counts.select(F.inline(cells))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(label, precision, recall, f1, support): classes, accuracy, macro and weighted means."""
    return _report_of(_cells(df, y, pred))


def _report_of(cells: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(label: str, hit: Column, extra: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            _ratio(hit, hit + extra).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + extra + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    classes = cells.select(
        "*", line("0", tn, fn, fp).alias("zero"), line("1", tp, fp, fn).alias("one")
    )
    zero, one = F.col("zero"), F.col("one")
    n = zero["support"] + one["support"]

    def mean(label: str, combine) -> Column:
        return F.struct(
            F.lit(label).alias("label"),
            *[combine(m).alias(m) for m in ("precision", "recall", "f1")],
            n.alias("support"),
        )

    nothing = F.lit(None).cast("double")
    accuracy = F.struct(
        F.lit("accuracy").alias("label"), nothing.alias("precision"), nothing.alias("recall"),
        _ratio(tp + tn, n).alias("f1"), n.alias("support"),
    )
    macro = mean("macro avg", lambda m: (zero[m] + one[m]) / 2)
    weighted = mean(
        "weighted avg",
        lambda m: _ratio(zero[m] * zero["support"] + one[m] * one["support"], n),
    )
    return classes.select(F.inline(F.array(zero, one, accuracy, macro, weighted)))


def roc_auc(df: DataFrame, y: str, p: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row (auc) by the rank formula, ties counting half.

    Rows are merged per score before anything is ordered.  Scores are cut into
    slices of ``slice_rows``: the negatives below a score are those of lower slices
    plus those below it in its own slice.
    """
    return _auc_of(score_counts(df, y, p), slice_rows)


def _auc_of(scores: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    def before(c: str, w) -> Column:
        return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    cut = ranged(scores, ["p"], slice_rows)
    lower = (
        cut.groupBy("_slice").agg(F.sum("neg").alias("neg"))
        .select("_slice", before("neg", Window.orderBy("_slice")).alias("_lower"))
    )
    own = Window.partitionBy("_slice").orderBy("p")
    ranked = cut.join(lower, "_slice").withColumn("below", F.col("_lower") + before("neg", own))
    won = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


@dataclass
class Evaluation:
    """All figures of one set of scores; the frames read the written table of counts by score."""

    counts: DataFrame
    threshold: float
    f1: float
    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame
    auc: DataFrame


def evaluate_scores(
    df: DataFrame,
    y: str,
    p: str,
    threshold: float | None = None,
    thresholds: tuple[float, float, int] = (
        D.THRESHOLD_START, D.THRESHOLD_STEP, D.THRESHOLD_COUNT,
    ),
    slice_rows: int = SLICE_ROWS,
) -> Evaluation:
    """Threshold, metrics, confusion, report and AUC of scores that are read once.

    The rows are merged per score and written; everything else is an aggregation of that table.
    Without ``threshold`` the one with the highest F1 is taken, and ``f1`` is then its F1.  The
    decision is ``p >= threshold``.
    """
    counts = materialize(score_counts(df, y, p))
    start, step, count = thresholds
    reached = _thresholds_reached(F.col("p"), start, step, count).alias("bin")
    bins = counts.groupBy(reached).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    best = _best_of(bins, start, step).first()
    chosen = best["threshold"] if threshold is None else float(threshold)
    yes = F.col("p") >= F.lit(chosen)

    def rows(c: str, decided: Column) -> Column:
        return F.coalesce(F.sum(F.when(decided, F.col(c))), F.lit(0))

    cells = counts.agg(
        rows("neg", ~yes).alias("tn"), rows("neg", yes).alias("fp"),
        rows("pos", ~yes).alias("fn"), rows("pos", yes).alias("tp"),
    )
    metrics = _metrics_of(cells)
    f1 = best["f1"] if threshold is None else metrics.first()["f1"]
    return Evaluation(
        counts, chosen, f1, metrics, _confusion_of(cells), _report_of(cells), _auc_of(counts, slice_rows))
