"""Regions on the map, the risk fact and reads by day."""

from pyspark.sql import functions as F

from queries.inputs import (
    FACT_CTE, REGIONS_CTE, located_cte, point, point_sql, predictions, regions, table,
)
from queries.registry import query
from stormgrid import operators as op
from stormgrid.plans.weather import located_points

DAY = "2024-01-15"
_STYLE_SQL = """
    CASE WHEN f.alcaldia IS NULL THEN '#cbd5e1' WHEN riesgo = 'BAJO' THEN '#10b981'
         WHEN riesgo = 'MEDIO' THEN '#f59e0b' WHEN riesgo = 'ALTO' THEN '#ef4444'
         ELSE '#94a3b8' END AS fill_color,
    CASE WHEN f.alcaldia IS NULL THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END
        AS fill_opacity,
    '#ffffff' AS border_color, CAST(2 AS DOUBLE) AS border_width
"""


@query(f"""
    WITH puntos AS (SELECT c_custkey, {point_sql("c_custkey")} FROM customer),
    {REGIONS_CTE}, {located_cte("puntos")}
    SELECT c_custkey, lat, lon, alcaldia FROM puntos JOIN located USING (lat, lon)
""")
def point_in_region(spark, sf_dir):
    """Distinct points are tested once, then attached to every row that has them."""
    rows = table(spark, sf_dir, "customer").withColumns(point("c_custkey")).select(
        "c_custkey", "lat", "lon"
    )
    located = located_points(rows, regions(spark, sf_dir), cell=0.5)
    return op.attach(rows, located, ["lat", "lon"])


@query(f"WITH {FACT_CTE} SELECT * FROM fact")
def fact_latest(spark, sf_dir):
    return op.fact_risk(predictions(spark, sf_dir), ["ts", "event_id"])


@query("""
    SELECT DISTINCT CAST(ts AS DATE) AS fecha, CAST(year(ts) AS INTEGER) AS anio,
           CAST(month(ts) AS INTEGER) AS mes, CAST(day(ts) AS INTEGER) AS dia FROM events
""")
def time_dimension(spark, sf_dir):
    return op.dim_time(predictions(spark, sf_dir))


@query("SELECT DISTINCT 'NATION_' || (user_id % 20) AS alcaldia FROM events")
def region_dimension(spark, sf_dir):
    return op.dim_region(predictions(spark, sf_dir))


@query(f"WITH {FACT_CTE} SELECT min(fecha) AS min, max(fecha) AS max FROM fact")
def date_range(spark, sf_dir):
    return op.date_range(fact_latest(spark, sf_dir))


@query(f"""
    WITH {FACT_CTE}
    SELECT alcaldia, probabilidad, prediccion, valor_real, riesgo FROM fact
    WHERE fecha = DATE '{DAY}'
""")
def cube_slice(spark, sf_dir):
    """One day of the fact: the date filter is the feature."""
    return op.slice_by_date(fact_latest(spark, sf_dir), DAY)


@query(f"""
    WITH {FACT_CTE}
    SELECT alcaldia, probabilidad, riesgo FROM fact WHERE fecha = DATE '{DAY}'
    ORDER BY probabilidad DESC, alcaldia
""")
def cube_ranked(spark, sf_dir):
    return op.ranked(fact_latest(spark, sf_dir), DAY)


@query(f"""
    WITH {FACT_CTE}
    SELECT n_name AS alcaldia, f.riesgo, {_STYLE_SQL}
    FROM nation LEFT JOIN (SELECT * FROM fact WHERE fecha = DATE '{DAY}') f ON f.alcaldia = n_name
""")
def region_style(spark, sf_dir):
    names = op.rename(table(spark, sf_dir, "nation"), {"n_name": "alcaldia"}).select("alcaldia")
    return op.style(names, op.slice_by_date(fact_latest(spark, sf_dir), DAY), "alcaldia")


@query(f"""
    WITH {FACT_CTE},
    kinds AS (
        SELECT n_name, n_nationkey % 3 AS kind, CAST((n_nationkey % 5) * 2 AS DOUBLE) AS x,
               CAST(((n_nationkey // 5) % 5) * 2 AS DOUBLE) AS y FROM nation
    ), shapes AS (
        SELECT n_name, CASE kind
            WHEN 0 THEN [[[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2], [x, y]]]
            WHEN 1 THEN [[[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2], [x, y]],
                         [[x + 0.5, y + 0.5], [x + 1.5, y + 0.5], [x + 1.5, y + 1.5],
                          [x + 0.5, y + 1.5], [x + 0.5, y + 0.5]]]
            ELSE [[[x, y], [x + 2, y], [x + 2, y + 2], [x + 1, y + 0.5], [x, y + 2], [x, y]]]
            END AS rings FROM kinds
    )
    SELECT n_name AS name, n_name AS display_name, f.riesgo, {_STYLE_SQL},
           '{{"type":"Feature","properties":{{"name":"' || n_name || '","display_name":"' || n_name
           || '"}},"geometry":{{"type":"Polygon","coordinates":' || CAST(to_json(rings) AS VARCHAR)
           || '}}}}' AS feature
    FROM shapes LEFT JOIN (SELECT * FROM fact WHERE fecha = DATE '{DAY}') f ON f.alcaldia = n_name
""")
def region_features(spark, sf_dir):
    return op.region_features(regions(spark, sf_dir), fact_latest(spark, sf_dir), DAY)
