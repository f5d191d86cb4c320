"""Files in and out, nested feeds, logs, joins and audit rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.operators import audit as au
from aerostrata.operators import joins as jn
from aerostrata.schema import AIR_FIELDS, LIVE_WEATHER_FIELDS, READINGS_CSV, WEATHER_FIELDS, hourly_response
from aerostrata.sinks import tables as sk
from aerostrata.sources import logs as lg
from aerostrata.sources import nested as ns
from aerostrata.sources import readings as rd

HEADER = ",".join(READINGS_CSV.fieldNames())


def test_csv_reads_only_csv_and_nulls_bad_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER + "\nS1,n,r,1,2,2024-01-01T00:00,1.5,,x,1,1,1,50,Baik,20,50,3,0,10\n")
    (tmp_path / "b.csv").write_text(
        HEADER + "\nS2,n,r,1,2,2024-01-01T00:00,2.5,1,1,1,1,1,50,Baik,20,50,3,0,10\n")
    (tmp_path / "note.txt").write_text("ignored\n")
    rows = {r.station_id: r for r in rd.read_readings_csv(spark, str(tmp_path)).collect()}
    assert set(rows) == {"S1", "S2"}
    assert rows["S1"].pm10 is None and rows["S1"].co is None and rows["S1"].pm25 == 1.5


def test_empty_folder_gives_the_schema(spark, tmp_path):
    df = rd.read_readings_csv(spark, str(tmp_path))
    assert df.count() == 0 and df.columns == READINGS_CSV.fieldNames()


def test_csv_writes_missing_as_empty_field(spark, tmp_path):
    row = [None] * len(READINGS_CSV)
    row[0] = "S1"
    sk.write_readings_csv(spark.createDataFrame([tuple(row)], READINGS_CSV).coalesce(1), str(tmp_path / "o"))
    text = next((tmp_path / "o").glob("*.csv")).read_text().splitlines()
    assert text == [HEADER, "S1" + "," * (len(READINGS_CSV) - 1)]


def test_stations(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"city": "X", "stations": [
        {"id": "A", "name": "A1", "region": "R", "latitude": 1.0, "longitude": 2.0},
        {"id": "B", "name": "B1", "region": "R", "latitude": 3.0, "longitude": 4.0}]}, indent=2))
    got = rd.read_stations(spark, str(tmp_path / "c.json")).orderBy("station_id").collect()
    assert [(r.station_id, r.station_name, r.latitude) for r in got] == [("A", "A1", 1.0), ("B", "B1", 3.0)]


def responses(spark, rows, fields):
    doc = [(k, json.dumps({"hourly": h})) for k, h in rows.items()]
    return spark.createDataFrame(doc, "station_id string, j string").select(
        "station_id", F.from_json("j", hourly_response(fields)).alias("d")).select("station_id", "d.hourly")


def test_hourly_arrays_follow_the_air_time_axis(spark):
    air = responses(spark, {
        "A": {"time": ["t0", "t1", "t2"], "pm2_5": [1.0, None, 3.0], "pm10": [9.0]},
        "B": {"time": ["t0"], "pm2_5": [5.0, 6.0]},
        "C": {"time": []}, "D": {"time": ["t0"], "pm2_5": [1.0]}}, AIR_FIELDS)
    weather = responses(spark, {
        "A": {"time": ["t0"], "temperature_2m": [20.0, 21.0]}, "B": {"time": ["t0"]},
        "C": {"time": ["t0"]}}, WEATHER_FIELDS)
    got = [tuple(r) for r in ns.explode_hourly(air, weather, ["station_id"])
           .select("station_id", "tanggal", "pm25", "pm10", "co", "temperature").orderBy("station_id", "tanggal").collect()]
    assert got == [("A", "t0", 1.0, 9.0, None, 20.0), ("A", "t1", None, None, None, 21.0),
                   ("A", "t2", 3.0, None, None, None), ("B", "t0", 5.0, None, None, None)]


def test_current_values_and_merge(spark):
    air = spark.createDataFrame([("A", (1.0, 2.0)), ("B", (3.0, None))],
                                "station_id string, current struct<pm2_5:double,pm10:double>")
    wx = spark.createDataFrame([("B", (20.0,)), ("C", (30.0,))],
                               "station_id string, current struct<temperature_2m:double>")
    merged = jn.merge_feeds(ns.current_values(air, ["station_id"], AIR_FIELDS),
                            ns.current_values(wx, ["station_id"], LIVE_WEATHER_FIELDS), ["station_id"])
    got = {r.station_id: (r.pm25, r.pm10, r.temperature, r.uv_index) for r in merged.collect()}
    assert got == {"A": (1.0, 2.0, None, None), "B": (3.0, None, 20.0, None), "C": (None, None, 30.0, None)}


def test_logs(spark, tmp_path):
    (tmp_path / "one.log").write_text("\n".join([
        "2024-01-01T00:00:00 [INFO] etl - Batch ETL mulai", "noise",
        "2024-01-01T00:00:05 [INFO] etl - Insert 10 baris", "2024-01-01T00:00:06 [WARNING] etl - x",
        "__METRICS__:{bad", '__METRICS__:{"rows": 1}', "2024-01-01T00:00:09 [INFO] etl - Insert 12 baris",
        '__METRICS__:{"rows": 2}', "2024-01-01T00:01:10 [INFO] etl - Batch ETL selesai"]) + "\n")
    (tmp_path / "two.log").write_text("2024-01-01T00:00:00 [INFO] etl - Batch ETL mulai\n")
    logs = lg.read_logs(spark, str(tmp_path))
    got = {r.file.rsplit("/", 1)[1]: r for r in lg.extract_log_metrics(logs, lg.ETL_PATTERNS, lg.ETL_MARKS).collect()}
    one, two = got["one.log"], got["two.log"]
    assert (one.inserted, one.warnings, one.seconds, one.ok) == (12, 1, 70, True)
    assert (two.inserted, two.ended_at, two.ok) == (None, None, False)
    schema = T.StructType([T.StructField("rows", T.LongType())])
    assert [r.rows for r in lg.parse_metric_lines(logs, schema, "first").collect()] == [1]
    assert [r.rows for r in lg.parse_metric_lines(logs, schema, "last").collect()] == [2]


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("A", "2024-01-02", 9.0)]
    df = spark.createDataFrame(rows, "station_id string, d string, v double").select(
        "station_id", F.to_date("d").alias("date"), "v")
    for _ in range(2):
        sk.append_absent(df, path, ["station_id", "date"], [F.asc("v")])
    more = df.withColumn("v", F.lit(7.0)).unionByName(
        df.limit(1).withColumns({"date": F.lit("2024-01-03").cast("date")}))
    sk.append_absent(more, path, ["station_id", "date"], [F.asc("v")])
    got = sorted((str(r.date), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", 1.0)]


def test_partitioned_write_replaces_only_its_dates_and_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(4).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    sk.write_partitioned(df, path)
    sk.write_partitioned(df.filter("id = 1").withColumn("id", F.lit(100).cast("long")), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 100]
    one = spark.read.parquet(path).filter("date = date '2024-01-02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and one.count() == 1


def test_kafka_json_keeps_nulls(spark):
    df = spark.createDataFrame([("A", None)], "station_id string, v double")
    assert [tuple(r) for r in sk.to_kafka_json(df).collect()] == [("A", '{"station_id":"A","v":null}')]


def test_jdbc_options():
    o = sk.jdbc_options("jdbc:postgresql://h/db", "daily", user="u")
    assert o["dbtable"] == "daily" and o["batchsize"] == "10000" and o["user"] == "u"


def test_latest_and_ties(spark):
    df = spark.createDataFrame([("A", 1, 1), ("A", 2, 2), ("A", 2, 3), ("B", 1, 4)], "k string, t int, i int")
    assert sorted(r.i for r in jn.latest(df, ["k"], [F.desc("t")], ties=True).collect()) == [2, 3, 4]
    assert sorted(r.i for r in jn.latest(df, ["k"], [F.desc("t"), F.desc("i")]).collect()) == [3, 4]
    assert sorted(r.i for r in jn.at_latest(df, "t").collect()) == [2, 3]


def test_audit(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    log = au.audit_event(spark, "d", "r", "RUNNING", at=t).unionByName(
        au.audit_event(spark, "d", "r", "FAILED", error="x" * 600, at=t + dt.timedelta(seconds=9))).unionByName(
        au.audit_event(spark, "d", "q", "RUNNING", at=t))
    got = {r.run_id: r for r in au.latest_runs(log).collect()}
    assert got["r"].status == "FAILED" and len(got["r"].error_msg) == 500 and got["q"].status == "RUNNING"
    runs = {r.run_id: (r.seconds, r.status) for r in au.run_durations(log).collect()}
    assert runs == {"r": (9, "FAILED"), "q": (None, "RUNNING")}
    assert au.runs_like(log, "d%").count() == 3


def test_report_without_data(spark):
    from aerostrata.operators.alerts import station_report
    daily = spark.createDataFrame([], "station_id string, date date, ispu double, aqi_category string")
    preds = spark.createDataFrame([], "station_id string, predicted_label string, confidence double, created_at timestamp")
    rows = station_report(daily, preds, F.lit("2024-01-01").cast("date"), {"a": "b"}).collect()
    assert len(rows) == 1 and rows[0].station_id is None


def test_predictions_are_appended_with_version(spark, tmp_path):
    df = spark.createDataFrame([("A", "Baik", 0.9)], "station_id string, predicted_label string, confidence double")
    for v in ("1", "2"):
        sk.write_predictions(df, str(tmp_path / "p"), v)
    rows = spark.read.parquet(str(tmp_path / "p")).collect()
    assert sorted(r.model_version for r in rows) == ["1", "2"] and all(r.created_at for r in rows)


def test_append_may_be_run_again(spark, tmp_path, monkeypatch):
    from aerostrata.sinks import tables
    day = lambda rows: spark.createDataFrame(rows, "station_id string, date date, v int").withColumn("date", F.col("date"))
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    path, order = str(tmp_path / "t"), [F.desc("v")]
    read = lambda: sorted((r.station_id, r.date, r.v) for r in spark.read.parquet(path).collect())
    first = day([("a", d1, 1), ("a", d1, 9), ("b", d2, 2)])
    for _ in range(2):
        tables.append_absent(first, path, ["station_id", "date"], order)
        assert read() == [("a", d1, 9), ("b", d2, 2)]
    second = day([("a", d1, 100), ("b", d1, 3), ("a", d3, 4)])
    write = tables.write_partitioned

    def fails(df, path, by):
        write(df.filter(F.col("date") < F.lit(d3)), path, by)
        raise OSError("lost")

    monkeypatch.setattr(tables, "write_partitioned", fails)
    with pytest.raises(OSError):
        tables.append_absent(second, path, ["station_id", "date"], order)
    monkeypatch.undo()
    for _ in range(2):
        tables.append_absent(second, path, ["station_id", "date"], order)
        assert read() == sorted([("a", d1, 9), ("b", d2, 2), ("b", d1, 3), ("a", d3, 4)])
