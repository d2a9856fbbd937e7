"""The whole run over files."""

import datetime
import json

from stormgrid.operators import ranked
from stormgrid.plans.batch import evaluate, prepare
from stormgrid.plans.profile import stage_profile
from tests.conftest import rows


def _ring(x):
    return [[[x, 19.0], [x + 0.25, 19.0], [x + 0.25, 19.5], [x, 19.5], [x, 19.0]]]


def test_files_to_cube(spark, tmp_path):
    names = ["Álvaro Obregón", "Benito Juárez"]
    (tmp_path / "regions.geojson").write_text(json.dumps({"features": [
        {"properties": {"NOMGEO": n}, "geometry": {"type": "Polygon", "coordinates": _ring(-99.5 + i / 4)}}
        for i, n in enumerate(names)
    ]}), encoding="utf-8")
    start = datetime.date(2021, 1, 1)
    lines = ["fecha,lat,lon,precip,temp,humedad,viento,radiacion,presion"]
    for d in range(60):
        day = (start + datetime.timedelta(d)).strftime("%Y%m%d")
        for i, lon in enumerate((-99.4, -99.1, -90.0)):
            lines.append(f"{day},19.25,{lon},{(d * 5 + i * 3) % 11},20,{(d * 7) % 50},3,8,77")
    (tmp_path / "weather.csv").write_text("\n".join(lines))
    (tmp_path / "calls.csv").write_bytes((
        "folio,fecha_creacion,alcaldia_cierre,latitud,longitud,incidente_c4,codigo_cierre\n"
        "f1,2021-01-05 08:00:00,Álvaro Obregón,19.2,-99.2,Inundación,Afirmativo\n"
        "f2,2021-01-05 09:00:00,Álvaro Obregón,19.2,-99.2,Fuga de agua,A\n"
        "f3,2021-01-05 09:00:00,Álvaro Obregón,19.2,-99.2,Fuga de agua,N\n"
    ).encode("latin-1"))
    out = str(tmp_path / "out")
    features = prepare(
        spark, str(tmp_path / "weather.csv"), str(tmp_path / "calls.csv"),
        str(tmp_path / "regions.geojson"), out,
    )
    assert features.count() == 120
    hit = features.filter("alcaldia = 'ALVARO OBREGON' AND fecha = '2021-01-05'").first()
    assert (hit["inundacion"], hit["fuga_agua"], hit["total_incidentes"]) == (1, 1, 2)
    assert "punto_rocio" not in features.columns  # optional measures stay optional
    run = evaluate(features, out)
    assert run.predictions.count() == 120
    fact = spark.read.parquet(f"{out}/cube/fact_risk")
    assert ranked(fact, "2021-01-05").count() == 2
    text = spark.read.option("header", True).csv(f"{out}/predictions_csv")
    assert text.count() == 120


def test_stage_profile(spark):
    df = spark.sql("SELECT date'2021-01-01' AS fecha, 'A' AS alcaldia, 2 AS n UNION ALL SELECT NULL, 'B', 3")
    got = {(r["metric"], r["column"]): r["value"] for r in stage_profile(df).collect()}
    assert got == {
        ("rows", ""): "2", ("columns", ""): "3", ("nulls", "fecha"): "1", ("nulls", "alcaldia"): "0",
        ("nulls", "n"): "0", ("total", "n"): "5", ("distinct", "alcaldia"): "2",
        ("min", "fecha"): "2021-01-01", ("max", "fecha"): "2021-01-01",
    }
    assert len(rows(stage_profile(df))) == 9


def test_coordinates_are_numbers_before_anything_is_joined(spark, tmp_path):
    from stormgrid.plans.weather import clean_weather
    from stormgrid.sources.regions import read_regions

    (tmp_path / "r.geojson").write_text(json.dumps({"features": [
        {"properties": {"NOMGEO": "A"}, "geometry": {"type": "Polygon", "coordinates": _ring(-99.5)}}]}))
    lines = [("20210101", "19.250", "-99.4", "5"), ("20210102", "19.25", "-99.40", "-999"), ("20210103", "n/d", "-99.4", "1"),
             ("20210103", "19.25", None, "1")]
    raw = spark.createDataFrame([(*x[:3], x[3], "20", "50", "3", "8", "77") for x in lines],
                                "fecha string, lat string, lon string, precip string, temp string, humedad string, "
                                "viento string, radiacion string, presion string")
    out = clean_weather(raw, read_regions(spark, str(tmp_path / "r.geojson")), 0.05)
    assert dict(out.dtypes)["lat"] == "double"
    assert rows(out.select("fecha", "lat", "precip")) == [
        (datetime.date(2021, 1, 1), 19.25, 5.0), (datetime.date(2021, 1, 2), 19.25, 5.0)]


def test_call_days_of_many_shapes(spark):
    from stormgrid import defaults as D
    from stormgrid.plans.calls import clean_calls, unread_days

    days = ["13/01/2019", "01/02/2019", "2019-01-02T03:04:05Z", "2019-01-02 03:04:05+00:00", "2019/01/02 10:30",
            "01/02/2019 03:04:05 PM", "pendiente"]
    raw = spark.createDataFrame(
        [(f"f{i}", d, "Centro", "19.3", "-99.1", "Inundación", "A") for i, d in enumerate(days)],
        "folio string, fecha_creacion string, alcaldia_cierre string, latitud string, longitud string, "
        "incidente_c4 string, codigo_cierre string")
    assert clean_calls(raw).count() == 5  # day first is a choice
    assert clean_calls(raw, day_formats=["d/M/yyyy", *D.DAY_FORMATS]).count() == 6
    assert rows(unread_days(raw)) == [(7, 2)]


def test_no_silent_local_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from stormgrid import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
