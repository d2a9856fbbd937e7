"""Splits, scaling, thresholds and evaluation."""

from pyspark.sql import functions as F

from queries.inputs import SCORES_CTE, scores, table
from queries.registry import query
from stormgrid.functions import right_bins
from stormgrid import defaults as D
from stormgrid import operators as op


@query("""
    SELECT quality, count(*) AS n,
           CAST((SELECT count(*) FROM labels) AS DOUBLE) / (2 * count(*)) AS weight
    FROM labels GROUP BY quality
""")
def class_weights(spark, sf_dir):
    return op.class_weights(table(spark, sf_dir, "labels"), "quality")


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber,
           round((l_quantity - (SELECT avg(l_quantity) FROM lineitem))
                 / (SELECT stddev_pop(l_quantity) FROM lineitem), 4) AS l_quantity,
           round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
                 / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 4) AS l_extendedprice
    FROM lineitem
""")
def standardize(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", *cols
    )
    return op.standardize(rows, cols).withColumns({c: F.round(c, 4) for c in cols})


@query(f"""
    WITH {SCORES_CTE},
    umbrales AS (
        SELECT CAST(0.01 AS DOUBLE) + i * ((CAST(0.01 AS DOUBLE) + CAST(0.01 AS DOUBLE))
                                           - CAST(0.01 AS DOUBLE)) AS t
        FROM range(99) r(i)
    ), f AS (
        SELECT t, CAST(2 * count(*) FILTER (y = 1 AND p >= t) AS DOUBLE)
                  / (2 * count(*) FILTER (y = 1 AND p >= t) + count(*) FILTER (y = 0 AND p >= t)
                     + count(*) FILTER (y = 1 AND p < t)) AS f1
        FROM scores, umbrales GROUP BY t
    )
    SELECT t AS threshold, f1 FROM f ORDER BY f1 DESC, t LIMIT 1
""")
def best_threshold(spark, sf_dir):
    return op.best_threshold(scores(spark, sf_dir), "y", "p")


@query(f"""
    WITH {SCORES_CTE}, c AS (
        SELECT count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
               count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn
        FROM scores
    )
    SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
           CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / (tp + fn) AS recall,
           CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1
    FROM c
""")
def binary_metrics(spark, sf_dir):
    return op.binary_metrics(scores(spark, sf_dir), "y", "pred")


@query(f"""
    WITH {SCORES_CTE}
    SELECT CAST(a.i AS INTEGER) AS actual, CAST(b.i AS INTEGER) AS predicted,
           (SELECT count(*) FROM scores WHERE y = a.i AND pred = b.i) AS n
    FROM range(2) a(i), range(2) b(i)
""")
def confusion_matrix(spark, sf_dir):
    return op.confusion(scores(spark, sf_dir), "y", "pred")


@query(f"""
    WITH {SCORES_CTE}, c AS (
        SELECT CAST(count(*) FILTER (y = 1 AND pred = 1) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (y = 0 AND pred = 1) AS DOUBLE) AS fp,
               CAST(count(*) FILTER (y = 1 AND pred = 0) AS DOUBLE) AS fn,
               CAST(count(*) FILTER (y = 0 AND pred = 0) AS DOUBLE) AS tn FROM scores
    ), r AS (
        SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,
               tn + fp AS s0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,
               2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1, (tp + tn) / (tp + tn + fp + fn) AS acc
        FROM c
    )
    SELECT '0' AS label, round(p0, 9) AS precision, round(r0, 9) AS recall, round(f0, 9) AS f1,
           CAST(s0 AS BIGINT) AS support FROM r
    UNION ALL SELECT '1', round(p1, 9), round(r1, 9), round(f1, 9), CAST(s1 AS BIGINT) FROM r
    UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 9), CAST(s0 + s1 AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 9), round((r0 + r1) / 2, 9),
                     round((f0 + f1) / 2, 9), CAST(s0 + s1 AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 9),
                     round((r0 * s0 + r1 * s1) / (s0 + s1), 9),
                     round((f0 * s0 + f1 * s1) / (s0 + s1), 9), CAST(s0 + s1 AS BIGINT) FROM r
""")
def class_report(spark, sf_dir):
    report = op.class_report(scores(spark, sf_dir), "y", "pred")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query(f"""
    WITH {SCORES_CTE},
    g AS (
        SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
        FROM scores GROUP BY p
    ), h AS (
        SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS below FROM g
    )
    SELECT round(CAST(sum(2 * pos * below + pos * neg) AS DOUBLE)
                 / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) AS auc
    FROM h
""")
def roc_auc(spark, sf_dir):
    return op.roc_auc(scores(spark, sf_dir), "y", "p").select(F.round("auc", 9).alias("auc"))


@query(f"""
    WITH {SCORES_CTE}
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN q < 0 THEN NULL WHEN q <= CAST(0.33 AS DOUBLE) THEN 'BAJO'
                WHEN q <= CAST(0.66 AS DOUBLE) THEN 'MEDIO' WHEN q <= 1 THEN 'ALTO' END AS riesgo
    FROM (SELECT *, p * CAST(1.25 AS DOUBLE) - CAST(0.125 AS DOUBLE) AS q FROM scores)
""")
def risk_bins(spark, sf_dir):
    """Scores stretched beyond both ends, where bins give null."""
    q = F.col("p") * 1.25 - 0.125
    return scores(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        right_bins(q, D.RISK_EDGES, D.RISK_LABELS).alias("riesgo"),
    )


def _event_model(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("tipo"),
        F.hour("ts").alias("hora"),
        F.weekday("ts").alias("dia_semana"),
        F.round(F.sqrt("value"), 3).alias("raiz"),
        (F.col("value") + 20 * (F.col("event_type") == "purchase").cast("int")
         + F.pmod(F.col("user_id") * 7, F.lit(31)) >= 70).cast("int").alias("y"),
    )
    return rows, op.fit_newton(rows, ["tipo"], ["hora", "dia_semana", "raiz"], "y")


def newton_sql(rows: str, key: str, category: str, categories: str, numbers: list[str], label: str, steps: int = 14) -> str:
    """CTEs up to ``odds(key, z)``: class-weighted, L2-penalised logistic regression by Newton steps.

    ``rows`` names a CTE with the training rows, ``categories`` one with (value, j), the places of
    the category from 2; place 1 is the intercept.  The design is kept long (row, place, value).  A
    step solves its system by Gauss-Jordan elimination over a list of rows.
    """
    at = f"(SELECT max(j) FROM {categories})"
    scaled = [
        f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM {rows})) / coalesce(nullif((SELECT stddev_pop({c}) FROM {rows}), 0), 1)"
        for c in numbers
    ]
    parts = [f"SELECT {key} AS k, CAST(1 AS BIGINT) AS j, CAST(1 AS DOUBLE) AS x FROM design"]
    parts.append(f"SELECT {key}, c.j, 1 FROM design d JOIN {categories} c ON c.value = d.{category}")
    parts += [f"SELECT {key}, {at} + {i + 1}, {x} FROM design" for i, x in enumerate(scaled)]
    out = [f"""
    design AS MATERIALIZED (SELECT * FROM {{all}}),
    long AS MATERIALIZED ({" UNION ALL ".join(parts)}),
    weights AS MATERIALIZED (
        SELECT {key} AS k, CAST({label} AS DOUBLE) AS y,
               CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY {label})) AS c
        FROM {rows}
    ),
    size AS (SELECT max(j) AS n FROM long),
    b0 AS MATERIALIZED (SELECT j, CAST(0 AS DOUBLE) AS b FROM (SELECT DISTINCT j FROM long))"""]
    for s in range(1, steps + 1):
        out.append(f"""
    p{s} AS MATERIALIZED (
        SELECT k, c * p * (1 - p) AS w, c * (y - p) AS r
        FROM (SELECT l.k, any_value(y) AS y, any_value(c) AS c, 1 / (1 + exp(-sum(x * b))) AS p
              FROM long l JOIN b{s - 1} USING (j) JOIN weights v ON v.k = l.k GROUP BY l.k)
    ),
    h{s} AS MATERIALIZED (
        SELECT i, list(h ORDER BY j) AS row_ FROM (
            SELECT u.j AS i, v.j AS j, coalesce(g.h, 0) + CASE WHEN u.j = v.j AND u.j > 1 THEN 1 ELSE 0 END AS h
            FROM b0 u CROSS JOIN b0 v LEFT JOIN (
                SELECT d.j AS i, e.j AS j, sum(d.x * e.x * w) AS h
                FROM long d JOIN long e ON e.k = d.k JOIN p{s} p ON p.k = d.k GROUP BY d.j, e.j
            ) g ON g.i = u.j AND g.j = v.j
        ) GROUP BY i
    ),
    m{s} AS MATERIALIZED (
        SELECT list(list_append(row_, g) ORDER BY i) AS m FROM h{s} JOIN (
            SELECT l.j, sum(x * r) - any_value(CASE WHEN l.j > 1 THEN b ELSE 0 END) AS g
            FROM long l JOIN p{s} p ON p.k = l.k JOIN b{s - 1} b ON b.j = l.j GROUP BY l.j
        ) g ON g.j = i
    ),
    e{s} AS MATERIALIZED (
        SELECT list_reduce(list_transform(range(1, (SELECT n + 1 FROM size)), lambda k: [[CAST(k AS DOUBLE)]]),
            lambda a, at_: list_transform(a, lambda line, i:
                CASE WHEN i = at_[1][1]
                     THEN list_transform(line, lambda v: v / line[i])
                     ELSE list_transform(line, lambda v, j: v - line[CAST(at_[1][1] AS INTEGER)]
                          * a[CAST(at_[1][1] AS INTEGER)][j]
                          / a[CAST(at_[1][1] AS INTEGER)][CAST(at_[1][1] AS INTEGER)]) END),
            m) AS solved
        FROM m{s}
    ),
    b{s} AS MATERIALIZED (SELECT j, b + solved[j][-1] AS b FROM b{s - 1}, e{s})""")
    out.append(f"""
    odds AS (SELECT k, sum(x * b) AS z FROM long JOIN b{steps} USING (j) GROUP BY k)""")
    return ",".join(out)


_EVENT_ROWS = """
    rows_ AS MATERIALIZED (
        SELECT event_id, event_type AS tipo, CAST(hour(ts) AS INTEGER) AS hora,
               CAST(isodow(ts) - 1 AS INTEGER) AS dia_semana, round(sqrt(value), 3) AS raiz,
               CAST(value + 20 * CAST(event_type = 'purchase' AS INTEGER) + (user_id * 7) % 31 >= 70 AS INTEGER) AS y
        FROM events
    ),
    kinds AS (
        SELECT tipo AS value, row_number() OVER (ORDER BY tipo) + 1 AS j FROM (SELECT DISTINCT tipo FROM rows_)
    )"""


@query(f"""
    WITH {_EVENT_ROWS.strip()},
    {newton_sql("rows_", "event_id", "tipo", "kinds", ["hora", "dia_semana", "raiz"], "y").replace("{all}", "rows_").strip()}
    SELECT event_id, y, round(1 / (1 + exp(-z)), 6) AS p FROM rows_ JOIN odds ON k = event_id
""")
def logistic_scores(spark, sf_dir):
    """Weighted logistic regression, solved to the last digits by Newton steps on both sides."""
    rows, model = _event_model(spark, sf_dir)
    return op.positive_probability(model, rows).select(
        "event_id", "y", F.round("p", 6).alias("p")
    )
