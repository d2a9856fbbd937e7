"""The stages end to end: weather and calls to panel, features and risk table."""

from pyspark.sql import functions as F

from queries.inputs import CALLS_CTE, WEATHER_CTE, calls_raw, regions, weather_raw
from queries.registry import query
from queries.scoring import newton_sql
from stormgrid import defaults as D
from stormgrid.operators import sentinel_counts
from stormgrid.plans.calls import clean_calls, daily_incidents
from stormgrid.plans.panel import build_features, build_panel
from stormgrid.plans.profile import stage_profile
from stormgrid.plans.risk import train_and_score
from stormgrid.plans.weather import clean_weather, typed_weather

REGION_CELL = 0.5
M = D.WEATHER_MEASURES
COUNTS = D.INCIDENT_COLUMNS + D.INCIDENT_TOTALS


@query(f"""
    WITH {WEATHER_CTE}
    SELECT fecha, lat, lon, {", ".join(M)}, alcaldia FROM weather_clean
""")
def weather_clean(spark, sf_dir):
    """The raw table is grouped by point and day, so a point's rows are bounded by days."""
    return clean_weather(
        weather_raw(spark, sf_dir), regions(spark, sf_dir), REGION_CELL, slice_rows=None
    )


@query(f"""
    WITH {WEATHER_CTE},
    medidas AS (
        SELECT TRY_CAST(precip AS DOUBLE) AS precip, TRY_CAST(temp_min AS DOUBLE) AS temp_min
        FROM weather_raw JOIN located USING (lat, lon)
        WHERE try_strptime(fecha, '%Y%m%d') IS NOT NULL
    )
    SELECT 'precip' AS "column", count(*) FILTER (precip <= -99) AS invalid FROM medidas
    UNION ALL SELECT 'temp_min', count(*) FILTER (temp_min <= -99) FROM medidas
""")
def weather_invalid(spark, sf_dir):
    typed = typed_weather(weather_raw(spark, sf_dir), regions(spark, sf_dir), REGION_CELL)
    return sentinel_counts(typed, ["precip", "temp_min"])


@query(f"WITH {CALLS_CTE} SELECT * FROM calls_clean")
def calls_clean(spark, sf_dir):
    return clean_calls(calls_raw(spark, sf_dir))


@query(f"WITH {CALLS_CTE} SELECT * FROM incidents_daily")
def incidents_daily(spark, sf_dir):
    return daily_incidents(calls_clean(spark, sf_dir))


@query(f"""
    WITH {CALLS_CTE}
    SELECT 'rows' AS metric, '' AS "column", CAST(count(*) AS VARCHAR) AS value FROM incidents_daily
    UNION ALL SELECT 'columns', '', '10'
    {" ".join(
        f"UNION ALL SELECT 'nulls', '{c}', "
        f"CAST(count(*) FILTER ({c} IS NULL) AS VARCHAR) FROM incidents_daily"
        for c in ["fecha", "alcaldia", *COUNTS])}
    {" ".join(
        f"UNION ALL SELECT 'total', '{c}', CAST(sum({c}) AS VARCHAR) FROM incidents_daily"
        for c in COUNTS)}
    UNION ALL SELECT 'distinct', 'alcaldia', CAST(count(DISTINCT alcaldia) AS VARCHAR)
              FROM incidents_daily
    UNION ALL SELECT 'min', 'fecha', CAST(min(fecha) AS VARCHAR) FROM incidents_daily
    UNION ALL SELECT 'max', 'fecha', CAST(max(fecha) AS VARCHAR) FROM incidents_daily
""")
def incidents_profile(spark, sf_dir):
    return stage_profile(incidents_daily(spark, sf_dir))


PANEL_CTE = f"""
    {WEATHER_CTE.strip()}, {CALLS_CTE.strip()},
    means AS (
        SELECT fecha, alcaldia, {", ".join(f"avg({m}) AS {m}" for m in M)}
        FROM weather_clean GROUP BY fecha, alcaldia
    ),
    panel AS (
        SELECT m.*, {", ".join(f"CAST(coalesce({c}, 0) AS INTEGER) AS {c}" for c in COUNTS)}
        FROM means m LEFT JOIN incidents_daily USING (fecha, alcaldia)
    )"""


def _panel(spark, sf_dir):
    return build_panel(
        weather_clean(spark, sf_dir), incidents_daily(spark, sf_dir), normalized=True
    )


@query(f"WITH {PANEL_CTE} SELECT * FROM panel")
def risk_panel(spark, sf_dir):
    return _panel(spark, sf_dir)


def _feature_sql() -> str:
    def past(c: str, n: int) -> str:
        if n == 1:
            return f"lag({c}) OVER w AS {c}_1d"
        return f"sum({c}) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {c}_{n}d"

    windows = [past("precip", n) for n in (1, *D.RAIN_WINDOWS)]
    windows += [past(c, n) for c in D.LAGGED_INCIDENTS for n in (1, *D.INCIDENT_WINDOWS)]
    pasts = [w.rsplit(" ", 1)[1] for w in windows]

    def out(expr: str, name: str) -> str:
        return f"round(coalesce(CAST({expr} AS DOUBLE), 0), 6) AS {name}"

    rain = "lluvia_acumulada_ponderada"
    products = {**{k: f"{a} * {b}" for k, (a, b) in D.PRODUCTS.items()},
                **{k: f"{a} - {b}" for k, (a, b) in D.DIFFERENCES.items()}}
    logs = [out(f"ln(1 + coalesce({c}, 0))", c + "_log") for c in D.LOG_COLUMNS]
    return f"""
        WITH {PANEL_CTE},
        past AS (
            SELECT *, {", ".join(windows)} FROM panel
            WINDOW w AS (PARTITION BY alcaldia ORDER BY fecha)
        ),
        weighted AS (
            SELECT *, 0.5::DOUBLE * coalesce(precip_1d, 0)
                      + 0.3::DOUBLE * (coalesce(precip_3d, 0) / 3::DOUBLE)
                      + 0.2::DOUBLE * (coalesce(precip_7d, 0) / 7::DOUBLE) AS {rain}
            FROM past
        )
        SELECT fecha, alcaldia, {", ".join(out(m, m) for m in M)}, {", ".join(COUNTS)},
               {", ".join(out(p, p) for p in pasts)},
               {", ".join(out(e, k) for k, e in products.items())},
               CAST(month(fecha) AS INTEGER) AS mes, CAST(quarter(fecha) AS INTEGER) AS trimestre,
               CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana,
               CAST(month(fecha) IN (6, 7, 8, 9, 10) AS INTEGER) AS temporada_lluvias,
               CAST(coalesce(precip >= 5, false) AS INTEGER) AS lluvia_intensa,
               CAST(coalesce(precip_1d >= 1, false) AS INTEGER) AS llovio_ayer,
               CAST(coalesce(precip_1d >= 5, false) AS INTEGER) AS lluvia_intensa_ayer,
               {out(rain, rain)}, {", ".join(logs)}
        FROM weighted
    """


def features(spark, sf_dir):
    return build_features(_panel(spark, sf_dir))


@query(_feature_sql())
def feature_table(spark, sf_dir):
    """All 68 columns; doubles are rounded because engines add in different orders."""
    table = features(spark, sf_dir)
    doubles = [c for c, kind in table.dtypes if kind == "double"]
    return table.withColumns({c: F.round(c, 6) for c in doubles})


@query()
def risk_report(spark, sf_dir):
    """Split, fit, threshold and score of every region-day."""
    run = train_and_score(features(spark, sf_dir))
    return run.predictions.withColumn(
        "probabilidad_lluvia_intensa", F.round("probabilidad_lluvia_intensa", 6)
    )


@query()
def risk_evaluation(spark, sf_dir):
    """Hold-out figures of the same run in one row."""
    run = train_and_score(features(spark, sf_dir))
    return run.metrics.select(
        F.lit(run.threshold).alias("threshold"), *run.metrics.columns, run.auc.scalar().alias("auc")
    )


#: A model small enough to be solved again in SQL: one category and a few numbers.
FEW = ["humedad", "presion", "precip_1d", "precip_7d", "llovio_ayer", "temporada_lluvias"]
_RISK_CTE = f"""
    feats AS MATERIALIZED (SELECT fecha, alcaldia, {", ".join(FEW)}, {D.LABEL} FROM ({_feature_sql()})),
    numbered AS MATERIALIZED (
        SELECT *, row_number() OVER (ORDER BY fecha, alcaldia) AS k,
               CAST(floor(count(*) OVER () * {D.TRAIN_FRACTION}) AS BIGINT) AS cut
        FROM feats
    ),
    train AS MATERIALIZED (SELECT * FROM numbered WHERE k <= cut),
    kinds AS (
        SELECT alcaldia AS value, row_number() OVER (ORDER BY alcaldia) + 1 AS j
        FROM (SELECT DISTINCT alcaldia FROM train)
    ),
    {newton_sql("train", "k", "alcaldia", "kinds", FEW, D.LABEL).replace("{all}", "numbered").strip()},
    scored AS MATERIALIZED (
        SELECT n.*, 1 / (1 + exp(-z)) AS p, {D.LABEL} AS y FROM numbered n JOIN odds ON odds.k = n.k
    ),
    umbrales AS (
        SELECT CAST(0.01 AS DOUBLE) + i * ((CAST(0.01 AS DOUBLE) + CAST(0.01 AS DOUBLE))
                                           - CAST(0.01 AS DOUBLE)) AS t
        FROM range(99) r(i)
    ),
    best AS (
        SELECT t, CAST(2 * count(*) FILTER (y = 1 AND p >= t) AS DOUBLE)
                  / (2 * count(*) FILTER (y = 1 AND p >= t) + count(*) FILTER (y = 0 AND p >= t)
                     + count(*) FILTER (y = 1 AND p < t)) AS f1
        FROM scored, umbrales WHERE k > cut GROUP BY t ORDER BY f1 DESC, t LIMIT 1
    )"""


def _risk_few(spark, sf_dir):
    table = features(spark, sf_dir).select("fecha", "alcaldia", *FEW, D.LABEL)
    rounded = {c: F.round(c, 6) for c, kind in table.dtypes if kind == "double"}
    return train_and_score(table.withColumns(rounded))


@query(f"""
    WITH {_RISK_CTE.strip()}
    SELECT fecha, alcaldia, round(p, 6) AS probabilidad_lluvia_intensa,
           CAST(p >= t AS INTEGER) AS prediccion_lluvia_intensa, CAST(y AS INTEGER) AS valor_real,
           CASE WHEN p <= CAST(0.33 AS DOUBLE) THEN 'BAJO' WHEN p <= CAST(0.66 AS DOUBLE) THEN 'MEDIO'
                ELSE 'ALTO' END AS riesgo
    FROM scored, best
""")
def risk_report_few(spark, sf_dir):
    """Split, fit, threshold and score of every region-day, with few enough columns for SQL."""
    return _risk_few(spark, sf_dir).predictions.withColumn(
        "probabilidad_lluvia_intensa", F.round("probabilidad_lluvia_intensa", 6)
    )


@query(f"""
    WITH {_RISK_CTE.strip()},
    c AS (
        SELECT count(*) FILTER (y = 1 AND p >= t) AS tp, count(*) FILTER (y = 0 AND p >= t) AS fp,
               count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 0 AND p < t) AS tn
        FROM scored, best WHERE k > cut
    ), pairs AS (
        SELECT avg(CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0 END) AS auc
        FROM scored a, scored b WHERE a.k > a.cut AND b.k > b.cut AND a.y = 1 AND b.y = 0
    )
    SELECT t AS threshold, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
           coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
           coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
           CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, round(auc, 9) AS auc
    FROM c, best, pairs
""")
def risk_evaluation_few(spark, sf_dir):
    """Hold-out figures of that run, all from one table of counts by score."""
    run = _risk_few(spark, sf_dir)
    return run.metrics.select(
        F.lit(run.threshold).alias("threshold"), *run.metrics.columns,
        F.round(run.auc.scalar(), 9).alias("auc"))
