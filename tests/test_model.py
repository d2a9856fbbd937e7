"""Training against a Newton solver, and its encoders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid import operators as op
from tests.conftest import rows

N = 400


def data(seed=11):
    rng = np.random.default_rng(seed)
    region = rng.integers(0, 3, N)
    a, b = rng.normal(3, 2, N), rng.normal(-1, 0.5, N)
    odds = 0.9 * (a - 3) - 1.2 * (b + 1) + 0.6 * (region == 1) - 1.1
    y = (rng.random(N) < 1 / (1 + np.exp(-odds))).astype(int)
    return region, a, b, y


def newton(region, a, b, y):
    z = np.column_stack([(v - v.mean()) / v.std() for v in (a, b)])
    hot = np.column_stack([(region == k).astype(float) for k in range(3)])
    x = np.column_stack([np.ones(N), hot, z])
    w = np.where(y == 1, N / (2 * y.sum()), N / (2 * (N - y.sum())))
    penalty = np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + penalty @ beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + penalty
        beta = beta - np.linalg.solve(hessian, gradient)
    return beta, 1 / (1 + np.exp(-x @ beta))


@pytest.fixture(scope="module")
def training(spark):
    region, a, b, y = data()
    return spark.createDataFrame(
        [(i, f"r{r}", float(u), float(v), int(t)) for i, (r, u, v, t) in enumerate(zip(region, a, b, y))],
        "id int, alcaldia string, a double, b double, y int",
    ).repartition(3)


def test_coefficients_and_probabilities_equal_newton(spark, training):
    model = op.fit(training, ["alcaldia"], ["a", "b"], "y", tol=1e-12)
    beta, p = newton(*data())
    lr = model.stages[-1]
    assert lr.intercept == pytest.approx(beta[0], abs=1e-4)
    assert lr.coefficients.toArray() == pytest.approx(beta[1:], abs=1e-4)
    got = [r["p"] for r in op.positive_probability(model, training).orderBy("id").collect()]
    assert got == pytest.approx(p, abs=1e-4)


def test_unknown_region_encodes_to_zeros(spark, training):
    model = op.fit(training, ["alcaldia"], ["a", "b"], "y")
    new = training.limit(1).withColumn("alcaldia", F.lit("never seen"))
    assert model.transform(new).first()["alcaldia__v"].toArray().tolist() == [0.0, 0.0, 0.0]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    assert op.scaling(df, ["a", "c"]) == {"a": (2.0, 1.0), "c": (7.0, 1.0)}
    assert rows(op.standardize(df, ["a", "c"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    assert rows(op.class_weights(df, "y")) == [(0, 3, 4 / 6), (1, 1, 2.0)]


def test_one_class_is_refused(spark, training):
    with pytest.raises(ValueError, match="both classes"):
        op.fit(training.filter("y = 1"), [], ["a"], "y")


def test_score_table(spark, training):
    model = op.fit(training, ["alcaldia"], ["a", "b"], "y")
    table = op.score(model, training, 0.5, keys=["id"], label="y")
    assert table.columns == [
        "id", "probabilidad_lluvia_intensa", "prediccion_lluvia_intensa", "valor_real", "riesgo",
    ]
    got = table.collect()
    assert [r["id"] for r in got] == list(range(N))
    rank = {"BAJO": 0, "MEDIO": 1, "ALTO": 2}
    by_p = sorted(got, key=lambda r: r["probabilidad_lluvia_intensa"])
    ranks = [rank[r["riesgo"]] for r in by_p]
    assert ranks == sorted(ranks)
    assert all((r["probabilidad_lluvia_intensa"] >= 0.5) == r["prediccion_lluvia_intensa"] for r in got)


def test_more_categories_than_any_list(spark):
    """12,000 categories, numbered in order over several ranges."""
    from stormgrid.operators.model import category_index

    df = spark.range(12_000).select(F.format_string("c%05d", F.col("id") * 7 % 12_000).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    index = category_index(df.unionAll(df), "c")
    assert index.filter("n <> cast(substring(c, 2) as int)").count() == 0 and index.count() == 12_000
    model = op.fit(df, ["c"], [], "y", max_iter=2)
    scored = op.positive_probability(model, df.withColumn("c", F.when(F.col("y") == 0, F.lit("new")).otherwise(F.col("c"))))
    assert scored.count() == 12_000 and scored.filter("y = 0").select("p").distinct().count() == 1
