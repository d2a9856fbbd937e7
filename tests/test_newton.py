"""Newton steps against a dense solution, and figures from one table of counts by score."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid import operators as op
from stormgrid.operators import newton
from stormgrid.operators.metrics import evaluate_scores
from stormgrid.plans.risk import train_and_score
from tests.conftest import plan, rows
from tests.test_model import data, training  # noqa: F401  the fixture
from tests.test_model import newton as dense


def test_coefficients_to_the_last_digits(spark, training):  # noqa: F811
    model = op.fit_newton(training, ["alcaldia"], ["a", "b"], "y")
    beta, p = dense(*data())
    assert model.coefficients == pytest.approx(beta, abs=1e-10) and model.steps <= 12
    got = [r["p"] for r in op.positive_probability(model, training).orderBy("id").collect()]
    assert got == pytest.approx(p, abs=1e-10)


def test_both_solvers_agree(spark, training):  # noqa: F811
    exact, near = op.fit_newton(training, ["alcaldia"], ["a"], "y"), op.fit(training, ["alcaldia"], ["a"], "y", tol=1e-12)
    both = op.positive_probability(near, op.positive_probability(exact, training, "p1"), "p2")
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 1e-4


def test_partitioning_does_not_matter(spark, training):  # noqa: F811
    one, many = (op.fit_newton(training.repartition(n), ["alcaldia"], ["a", "b"], "y").coefficients for n in (1, 9))
    assert one == pytest.approx(many, abs=1e-10)


def test_shares_are_summed_by_spark(spark, training):  # noqa: F811
    scaled = op.scaling(training, ["a"])
    held = newton._rows(training, ["a"], scaled, {}, {}, "y", F.lit(1.0))
    gram, gradient, loss = newton._sums(held, np.zeros(2), 0)
    _, a, _, y = data()
    z = (a - a.mean()) / a.std()
    x = np.column_stack([np.ones(len(z)), z])
    assert gram == pytest.approx(x.T @ x / 4) and gradient == pytest.approx(x.T @ (y - 0.5))
    assert loss == pytest.approx(len(y) * np.log(2))


def test_unknown_and_missing_category_have_no_effect(spark, training):  # noqa: F811
    model = op.fit_newton(training, ["alcaldia"], ["a"], "y")
    one = training.filter("id = 0")
    new = one.withColumn("alcaldia", F.lit("never seen")).unionByName(one.withColumn("alcaldia", F.lit(None)))
    a = one.first()["a"]
    mean, std = model.scaled["a"]
    want = 1 / (1 + np.exp(-(model.intercept + model.slopes["a"] * (a - mean) / std)))
    assert [r["p"] for r in model.transform(new).collect()] == pytest.approx([want] * 2)


def test_separable_and_constant_columns(spark):
    df = spark.createDataFrame([(float(i), 7.0, int(i >= 10)) for i in range(20)], "a double, c double, y int")
    model = op.fit_newton(df, [], ["a", "c"], "y")
    assert np.isfinite(model.coefficients).all() and model.slopes["c"] == 0 and model.slopes["a"] > 0


def test_refused(spark, training):  # noqa: F811
    with pytest.raises(ValueError, match="both classes"):
        op.fit_newton(training.filter("y = 1"), [], ["a"], "y")
    with pytest.raises(ValueError, match="missing numbers in \\['a'\\]"):
        op.fit_newton(training.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), [], ["a"], "y")
    wide = training.withColumn("alcaldia", F.col("id").cast("string"))
    with pytest.raises(ValueError, match="columns"):
        op.fit_newton(wide, ["alcaldia"], ["a"], "y")


def panel(spark, regions=3):
    rng = np.random.default_rng(2)
    days = [(d, f"r{r}", float(rng.normal()), int(rng.random() < 0.4)) for d in range(60) for r in range(regions)]
    df = spark.createDataFrame(days, "d int, alcaldia string, temp double, lluvia_intensa int")
    return df.withColumn("fecha", F.date_add(F.lit("2021-01-01"), F.col("d"))).drop("d")


@pytest.mark.parametrize("tune_on", ["test", "train"])
def test_run_by_either_solver(spark, tune_on):
    exact, near = (train_and_score(panel(spark), tune_on=tune_on, solver=s) for s in ("newton", "lbfgs"))
    assert exact.predictions.count() == near.predictions.count() == 180
    assert abs(exact.f1 - near.f1) < 0.05 and exact.confusion.agg(F.sum("n")).first()[0] == 36
    assert type(exact.model).__name__ == "NewtonModel" and type(near.model).__name__ == "FittedModel"


def test_too_many_categories_take_the_other_way(spark):
    many = panel(spark, 10).withColumn("alcaldia", F.concat_ws("-", "alcaldia", "fecha"))
    assert type(train_and_score(many).model).__name__ == "FittedModel"


@pytest.mark.parametrize("solver", ["newton", "lbfgs"])
@pytest.mark.parametrize("only", [0, 1])
def test_early_part_of_one_class(spark, only, solver):
    """36 rows are held out; their labels are of both classes, or of the one as well."""
    early = panel(spark).withColumn(
        "lluvia_intensa", F.when(F.col("fecha") < "2021-02-18", only).otherwise(F.col("lluvia_intensa")))
    for df in (early, early.withColumn("lluvia_intensa", F.lit(only))):
        run = train_and_score(df, solver=solver)
        assert rows(run.predictions.select("probabilidad_lluvia_intensa").distinct()) == [(float(only),)]
        assert run.predictions.count() == 180 and run.confusion.agg(F.sum("n")).first()[0] == 36
        assert run.auc.first()[0] == (0.5 if df is early else None)
    found = run.metrics.first()
    # Without a positive no threshold is better than 0, at which all rows count as positive.
    assert (run.threshold, found["accuracy"], found["f1"]) == ((0.01, 1.0, 1.0) if only else (0.0, 0.0, 0.0))


def scored(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    held = [(int(rng.random() < 0.4), float(np.round(rng.random(), 2))) for _ in range(n)]
    return spark.createDataFrame([*held, (None, 0.5), (1, None)], "y int, p double").repartition(4)


@pytest.mark.parametrize("threshold", [None, 0.37])
def test_evaluation_equals_the_single_operators(spark, threshold):
    df = scored(spark)
    found = evaluate_scores(df, "y", "p", threshold)
    best = op.best_threshold(df, "y", "p").first()
    at = best["threshold"] if threshold is None else threshold
    decided = df.dropna().withColumn("pred", (F.col("p") >= at).cast("int"))
    assert found.threshold == at
    assert rows(found.metrics) == rows(op.binary_metrics(decided, "y", "pred"))
    assert rows(found.confusion) == rows(op.confusion(decided, "y", "pred"))
    assert rows(found.report) == rows(op.class_report(decided, "y", "pred"))
    assert rows(found.auc) == rows(op.roc_auc(df, "y", "p"))
    assert found.f1 == pytest.approx(rows(found.metrics)[0][3])


def test_evaluation_reads_the_scores_once(spark):
    found = evaluate_scores(scored(spark), "y", "p")
    for frame in (found.metrics, found.confusion, found.report, found.auc):
        assert "ExistingRDD" in plan(frame) and "LocalTableScan" not in plan(frame)


def test_evaluation_of_nothing(spark):
    found = evaluate_scores(scored(spark).filter("y > 5"), "y", "p")
    assert (found.threshold, found.f1) == (0.0, 0.0) and rows(found.auc) == [(None,)]
    assert [r["n"] for r in found.confusion.collect()] == [0, 0, 0, 0]
