"""Stage graphs on hand-made raw tables."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from stormgrid import defaults as D
from stormgrid.plans.calls import clean_calls, daily_incidents
from stormgrid.plans.panel import build_features, build_panel
from stormgrid.plans.risk import train_and_score, write_cube
from stormgrid.plans.weather import clean_weather, located_points, weather_from_payloads
from stormgrid.sources import with_edges
from stormgrid.sources.payload import PAYLOAD_SCHEMA
from tests.conftest import rows

D1, D2, D3 = (datetime.date(2021, 7, d) for d in (1, 2, 3))


@pytest.fixture(scope="module")
def regions(spark):
    squares = [(0, " Álvaro ", [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]),
               (1, "Benito", [[[1.0, 0.0], [2.0, 0.0], [2.0, 1.0], [1.0, 1.0]]])]
    df = spark.createDataFrame(squares, "ordinal int, NOMGEO string, rings array<array<array<double>>>")
    return with_edges(df)


def weather_row(fecha, lat, lon, precip, temp="20"):
    return (fecha, lat, lon, precip, temp, "1", "2", "3", "4")


WEATHER = "fecha string, lat double, lon double, PRECTOTCORR string, T2M string, RH2M string, " \
          "WS2M string, ALLSKY_SFC_SW_DWN string, PS string"


def test_weather_cleaning(spark, regions):
    raw = spark.createDataFrame([
        weather_row("20210701", 0.5, 0.5, "-999"),
        weather_row("20210702", 0.5, 0.5, "4.0", "-99"),
        weather_row("20210703", 0.5, 0.5, "n/d", "22"),
        weather_row("20211301", 0.5, 0.5, "9"),
        weather_row("20210701", 0.5, 1.0, "1", "-98.9"),
        weather_row("20210701", 5.0, 5.0, "1"),
    ], WEATHER)
    got = clean_weather(raw, regions).select("fecha", "lon", "alcaldia", "precip", "temp")
    assert rows(got) == [
        (D1, 0.5, "ALVARO", 4.0, 20.0), (D1, 1.0, "ALVARO", 1.0, -98.9),
        (D2, 0.5, "ALVARO", 4.0, 20.0), (D3, 0.5, "ALVARO", 4.0, 22.0),
    ]


def test_weather_keeps_a_given_region(spark, regions):
    raw = spark.createDataFrame([weather_row("20210701", 0.5, 0.5, "1")], WEATHER)
    got = clean_weather(raw.withColumn("alcaldia", F.lit("ñu")), regions)
    assert [r["alcaldia"] for r in got.collect()] == ["NU"]


def test_weather_requires_its_columns(spark, regions):
    with pytest.raises(ValueError, match="presion"):
        clean_weather(spark.createDataFrame([("x",)], "fecha string"), regions)


def test_payloads_take_the_region_of_their_point(spark, regions):
    payloads = spark.createDataFrame(
        [(0.5, 0.5, ({"PRECTOTCORR": {"20210701": 3.0}},)), (9.0, 9.0, ({"PRECTOTCORR": {"20210701": 1.0}},))],
        PAYLOAD_SCHEMA,
    )
    points = located_points(payloads, regions)
    got = weather_from_payloads(payloads, points)
    assert rows(got.select("fecha", "alcaldia", "precip", "temp")) == [("20210701", " Álvaro ", 3.0, None)]


CALLS = "folio string, fecha_creacion string, alcaldia_cierre string, latitud string, " \
        "longitud string, incidente_c4 string, codigo_cierre string, otro string"


def call(i, day="2021-07-01 10:00:00", region="Álvaro", lat="19.3", lon="-99.1",
         kind="Inundación", code="A"):
    return (f"f{i}", day, region, lat, lon, kind, code, "-")


def test_calls_to_daily_counts(spark):
    raw = spark.createDataFrame([
        call(1), call(2, kind=" AGUAS \t negras ", code=" Afirmativo "),
        call(3, kind="Fuga de agua"), call(4, kind="Desborde Canal Río Presa", region=" alvaro"),
        call(5, code="N"), call(6, code=None), call(7, kind="Choque"), call(8, kind=None),
        call(9, day="ayer"), call(10, lat="x"), call(11, lat="19.61"), call(12, lat="19.6", lon="-98.9"),
        call(13, region=None), call(14, region="  "), call(15, day="2021-07-02", region="Benito"),
    ], CALLS)
    clean = clean_calls(raw)
    assert sorted(r["id_incidente"] for r in clean.collect()) == ["f1", "f12", "f15", "f2", "f3", "f4"]
    daily = rows(daily_incidents(clean))
    assert daily == [
        (D1, "ALVARO", 1, 1, 0, 1, 2, 5, 1, 1), (D2, "BENITO", 0, 0, 0, 0, 1, 1, 1, 1),
    ]
    with pytest.raises(ValueError, match="codigo_cierre"):
        clean_calls(raw.drop("codigo_cierre"))


def weather(spark, days=45, regions=("ALVARO", "BENITO")):
    start = datetime.date(2021, 5, 1)
    data = [
        (start + datetime.timedelta(d), r, float((d * 7 + i * 3) % 13), 20.0, 25.0, 15.0, 50.0, 3.0,
         8.0, 5.0, 77.0, 9.0, 12.0)
        for d in range(days) for i, r in enumerate(regions)
    ]
    return spark.createDataFrame(
        data, "fecha date, alcaldia string, " + ", ".join(f"{m} double" for m in D.WEATHER_MEASURES)
    ).repartition(3)


def incidents(spark):
    return spark.createDataFrame(
        [(datetime.date(2021, 5, 3), "alvaro", 1, 0, 0, 2, 0, 3, 0, 1)],
        "fecha date, alcaldia string, "
        + ", ".join(f"{c} int" for c in D.INCIDENT_COLUMNS + D.INCIDENT_TOTALS),
    )


def test_panel_and_features(spark):
    panel = build_panel(weather(spark), incidents(spark))
    assert len(panel.columns) == 21 and panel.count() == 90
    features = build_features(panel)
    assert len(features.columns) == 68
    got = features.filter("alcaldia = 'ALVARO'").orderBy("fecha").collect()
    rain = [float(d * 7 % 13) for d in range(45)]
    first, third, last = got[0], got[3], got[44]
    assert (first["precip_1d"], first["precip_30d"], first["llovio_ayer"]) == (0.0, 0.0, 0)
    assert third["fuga_agua_1d"] == 2.0 and third["total_incidentes_3d"] == 3.0
    assert got[2]["fuga_agua"] == 2 and got[2]["fuga_agua_1d"] == 0.0
    assert last["precip_1d"] == rain[43] and last["precip_30d"] == sum(rain[14:44])
    assert last["lluvia_intensa"] == int(rain[44] >= 5)
    assert last["rango_temp"] == 10.0 and last["depresion_punto_rocio"] == 8.0
    assert last["precip7_x_humedad"] == sum(rain[37:44]) * 50
    weighted = 0.5 * rain[43] + 0.3 * sum(rain[41:44]) / 3 + 0.2 * sum(rain[37:44]) / 7
    assert last["lluvia_acumulada_ponderada"] == pytest.approx(weighted)
    assert last["lluvia_acumulada_ponderada_log"] == pytest.approx(math.log1p(weighted))
    nulls = features.select([F.count_if(F.col(c).isNull()).alias(c) for c in features.columns]).first()
    assert not any(nulls)


def test_train_score_and_cube(spark, tmp_path):
    features = build_features(build_panel(weather(spark, 120), incidents(spark)))
    run = train_and_score(features)
    assert run.train.count() == int(240 * 0.8) and run.test.count() == 48
    assert run.predictions.count() == 240
    assert 0.0 <= run.threshold < 1.0
    assert run.metrics.first()["f1"] == pytest.approx(run.f1)
    assert sum(r["n"] for r in run.confusion.collect()) == 48
    assert run.report.count() == 5
    assert 0.0 <= run.auc.first()["auc"] <= 1.0
    path = str(tmp_path / "cube")
    write_cube(run.predictions, path, "probabilidad_lluvia_intensa")
    assert spark.read.parquet(f"{path}/fact_risk").count() == 240
    assert spark.read.parquet(f"{path}/dim_time").count() == 120
    assert spark.read.parquet(f"{path}/dim_region").count() == 2
    with pytest.raises(ValueError):
        train_and_score(features, tune_on="all")
