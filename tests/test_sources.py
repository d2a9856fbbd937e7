"""Files in and out: CSV, payloads, batches, streams."""

import datetime
import json

import pytest
from pyspark.sql import types as T

from stormgrid.sources import explode_parameters, land_batch, read_csv, read_payloads, write_table
from stormgrid.streaming.landing import land_payloads
from tests.conftest import rows


def test_csv_by_name_with_missing_words_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(
        'fecha,x,nota,extra\n2021-01-02,1.5,"dos\nlíneas, ""sí""",k\nNA,n/d,NULL,\n'.encode("latin-1")
    )
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("falta", T.LongType())])
    df = read_csv(spark, str(path), schema, encoding="ISO-8859-1", date_cols=["fecha"], multi_line=True)
    assert df.dtypes == [("fecha", "date"), ("x", "double"), ("nota", "string"), ("extra", "string")]
    assert rows(df) == [
        (datetime.date(2021, 1, 2), 1.5, 'dos\nlíneas, "sí"', "k"), (None, None, None, None),
    ]


def test_csv_schema_as_text(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("n,d\n1.0,3\nx,4\n")
    assert rows(read_csv(spark, str(path), "n int, d bigint")) == [(1, 3), (None, 4)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_table_overwrites(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    for n in (3, 2):
        write_table(spark.range(n).selectExpr("id", "id % 2 AS g"), path, ["g"], fmt)
    back = spark.read.option("header", True).format(fmt).load(path)
    assert back.count() == 2 and set(back.columns) == {"id", "g"}


def test_land_batch_replaces_only_its_batch(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_batch(spark.sql("SELECT 1 AS batch, 'a' AS v UNION ALL SELECT 2, 'b'"), path, "batch")
    land_batch(spark.sql("SELECT 2 AS batch, 'c' AS v"), path, "batch")
    assert rows(spark.read.parquet(path)) == [("a", 1), ("c", 2)]


def payload(lat, rain, temp=None):
    maps = {"PRECTOTCORR": rain}
    if temp is not None:
        maps["T2M"] = temp
    return json.dumps({"lat": lat, "lon": 1.0, "properties": {"parameter": maps}})


def test_payload_days_come_from_the_anchor(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text("\n".join([
        payload(1.0, {"20190102": 0.5, "20190103": 2}, {"20190102": 20, "20190109": 9}),
        payload(2.0, {"20190102": -999.0}),
        payload(3.0, {}),
    ]))
    df = explode_parameters(read_payloads(spark, str(path)))
    assert len(df.columns) == 14
    assert rows(df.select("fecha", "lat", "precip", "temp", "presion")) == [
        ("20190102", 1.0, 0.5, 20.0, None), ("20190102", 2.0, -999.0, None, None),
        ("20190103", 1.0, 2.0, None, None),
    ]


def test_stream_landing_continues_where_it_stopped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def land():
        query = land_payloads(spark, str(source), target, progress, files_per_batch=2)
        query.awaitTermination()
        return query

    for i in range(5):
        (source / f"{i}.json").write_text(payload(float(i), {"20190102": 1.0}))
    assert len(land().recentProgress) >= 3  # two files per batch
    assert spark.read.parquet(target).count() == 5
    (source / "5.json").write_text(payload(5.0, {"20190102": 1.0, "20190103": 1.0}))
    land()
    assert sorted(r["lat"] for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4, 5, 5]
