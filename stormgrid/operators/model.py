"""Class-weighted logistic regression on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormgrid import defaults as D
from stormgrid.functions.numeric import right_bins
from stormgrid.operators.columns import present
from stormgrid.operators.scale import lookup_join, ranged
from stormgrid.session import materialize


@dataclass
class FittedModel:
    """Category numbers and the fitted stages behind them."""

    indexes: dict[str, DataFrame]
    pipeline: PipelineModel

    @property
    def stages(self) -> list:
        return self.pipeline.stages

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(_indexed(df, self.indexes))


def category_index(df: DataFrame, col: str) -> DataFrame:
    """(``col``, n): the distinct values in order, numbered from 0.

    Values are numbered range by range, so their list is never in one task or on
    the driver.
    """
    values = df.select(col).dropna().distinct()
    cut = ranged(values, [col])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_slice").count().select(
        "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    own = F.row_number().over(Window.partitionBy("_slice").orderBy(col)) - 1
    return materialize(cut.join(starts, "_slice").select(col, (F.col("start") + own).alias("n")))


def _indexed(df: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Add ``<col>__i``; a value that was not there in training gets the number past the last."""
    for c, table in indexes.items():
        size = table.count()
        kind = {"ml_attr": {"type": "nominal", "name": f"{c}__i", "num_vals": size + 1}}
        numbered = lookup_join(df, table.withColumnRenamed("n", f"{c}__n"), [c], "left")
        number = F.coalesce(F.col(f"{c}__n"), F.lit(size)).cast("double")
        df = numbered.withColumn(f"{c}__i", number.alias(f"{c}__i", metadata=kind)).drop(f"{c}__n")
    return df


def select_features(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical, numeric) feature names the frame has."""
    return present(df, D.CATEGORICAL_FEATURES), present(df, D.NUMERIC_FEATURES)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with ``weight = rows / (2 * n)``."""
    counts = df.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    all_rows = counts.select(F.sum("n").alias("all")).scalar()
    return counts.withColumn("weight", all_rows / (2 * F.col("n")))


def scaling(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """column -> (mean, population standard deviation); a constant column gets 1."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def standardize(
    df: DataFrame, cols: Sequence[str], fitted: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Replace each column by ``(x - mean) / std``; fit on ``df`` unless given."""
    fitted = fitted or scaling(df, cols)
    return df.withColumns({
        c: (F.col(c) - F.lit(fitted[c][0])) / F.lit(fitted[c][1]) for c in cols
    })


def _scaled_sql(fitted: dict[str, tuple[float, float]]) -> str:
    parts = [
        f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {std!r}D AS `{c}__z`"
        for c, (mean, std) in fitted.items()
    ]
    return ", ".join(["SELECT *", *parts]) + " FROM __THIS__"


def fit(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str = D.LABEL,
    max_iter: int = D.MAX_ITERATIONS,
    tol: float = 1e-8,
) -> FittedModel:
    """One-hot + population scaling + L2 logistic regression with balanced classes.

    Unknown categories encode to zeros.  The penalty is one half of the squared
    coefficients against the summed weighted loss, which in Spark's averaged
    objective is ``regParam = 1 / sum(weights)``; the intercept is free.
    """
    categorical, numeric = list(categorical), list(numeric)
    counts = {r[label]: r["n"] for r in class_weights(train, label).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"label {label} needs both classes, found {sorted(counts)}")
    n = sum(counts.values())
    weight = F.when(F.col(label) == 1, n / (2 * counts[1])).otherwise(n / (2 * counts[0]))
    indexes = {c: category_index(train, c) for c in categorical}
    indexed = [f"{c}__i" for c in categorical]
    encoded = [f"{c}__v" for c in categorical]
    scaled = scaling(train, numeric)
    stages = [SQLTransformer(statement=_scaled_sql(scaled))]
    if categorical:
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
    stages += [
        VectorAssembler(
            inputCols=encoded + [f"{c}__z" for c in numeric], outputCol="features__"
        ),
        LogisticRegression(
            featuresCol="features__", labelCol=label, weightCol="weight__",
            rawPredictionCol="raw__", probabilityCol="probability__", predictionCol="class__",
            maxIter=max_iter, tol=tol, regParam=1.0 / n, elasticNetParam=0.0,
            standardization=False, family="binomial",
        ),
    ]
    rows = _indexed(train.withColumn("weight__", weight), indexes)
    return FittedModel(indexes, Pipeline(stages=stages).fit(rows))


def positive_probability(model, df: DataFrame, out: str = "p") -> DataFrame:
    """``df`` with the probability of class 1, by a ``FittedModel`` or a ``NewtonModel``."""
    if not isinstance(model, FittedModel):
        return model.transform(df, out)
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability__")[1].alias(out))


def risk_class(p: Column) -> Column:
    return right_bins(p, D.RISK_EDGES, D.RISK_LABELS)


def score(
    model,
    df: DataFrame,
    threshold: float,
    keys: Sequence[str] = ("fecha", "alcaldia"),
    label: str = D.LABEL,
    ordered: bool = True,
) -> DataFrame:
    """Prediction table: probability, decision, actual, risk; sorted by ``keys`` if ``ordered``."""
    p = F.col("p")
    table = (
        positive_probability(model, df)
        .select(
            *keys,
            p.alias("probabilidad_lluvia_intensa"),
            (p >= F.lit(float(threshold))).cast("int").alias("prediccion_lluvia_intensa"),
            F.col(label).cast("int").alias("valor_real"),
            risk_class(p).alias("riesgo"),
        )
    )
    return table.orderBy(*keys) if ordered else table
