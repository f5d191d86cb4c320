"""Streams driven to completion by file sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerostrata.operators.aggregate import window_agg
from aerostrata.operators.alerts import AlertRule, sustained_alerts
from aerostrata.operators.quality import dedup_stream
from aerostrata.operators.features import stream_features
from aerostrata.schema import AVERAGED, STREAM_MEASURES
from aerostrata.streaming import decode as dc
from aerostrata.streaming import progress as pg
from aerostrata.streaming import scoring as ss
from aerostrata.streaming import windows as sw
from aerostrata.streaming.alerts import alert_stream

BASE = dt.datetime(2024, 1, 1)


def land(spark, folder, rows, name):
    """One file of (station, minute, value) readings."""
    df = spark.createDataFrame([(s, BASE + dt.timedelta(minutes=m), float(v)) for s, m, v in rows],
                               "station_id string, event_time timestamp, v double")
    df = df.select("station_id", "event_time", *[F.col("v").alias(c) for c in [*AVERAGED, "precipitation"]])
    df.coalesce(1).write.mode("append").parquet(str(folder))
    return df


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def minutes(df, *columns):
    return sorted(tuple([r.station_id] + [int((r[c] - BASE).total_seconds() // 60) for c in columns])
                  for r in df.collect())


def test_window_stream_equals_batch_and_restarts_cleanly(spark, tmp_path):
    first = [("a", m, m % 50) for m in range(0, 60, 3)] + [("b", m, 7) for m in range(0, 60, 7)]
    df = land(spark, tmp_path / "in", first, "1")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    agg = lambda: sw.windowed(source(spark, tmp_path / "in", df.schema))
    sw.upsert_windows(agg(), out, state, every=None).awaitTermination()
    second = land(spark, tmp_path / "in", [("a", m, 1) for m in range(55, 90, 3)], "2")
    sw.upsert_windows(agg(), out, state, every=None).awaitTermination()
    sw.upsert_windows(agg(), out, state, every=None).awaitTermination()
    got = sw.read_windows(spark, out)
    want = window_agg(df.unionByName(second), "event_time")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert len({f["run"] for f in sw.read_manifest(spark, out)["folders"]}) == 1


def test_a_store_stays_small_and_right_while_it_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sw, "MERGE", 3)
    monkeypatch.setattr(sw, "KEEP", 4)
    out, want, early = str(tmp_path / "out"), {}, None
    for i in range(30):
        rows = [(s, BASE + dt.timedelta(minutes=5 * (i // 2)), float(i)) for s in "ab"[:1 + i % 2]]
        df = spark.createDataFrame(rows, "station_id string, window_start timestamp, v double").coalesce(1)
        sw.write_version(df, i, out, "q")
        want |= {(s, t): v for s, t, v in rows}
        if i == 26:
            early, then = sw.read_windows(spark, out), dict(want)
        if i == 28:
            assert {(r.station_id, r.window_start): r.v for r in early.collect()} == then
    read = lambda: {(r.station_id, r.window_start): r.v for r in sw.read_windows(spark, out).collect()}
    assert read() == want
    manifest = sw.read_manifest(spark, out)
    assert len(manifest["folders"]) <= 2 * 4 and max(f["level"] for f in manifest["folders"]) == 3
    assert len(list((tmp_path / "out" / "manifest").glob("*.json"))) <= 6
    assert len(list((tmp_path / "out" / "data").glob("level=*/run_id=*/batch_id=*"))) <= len(manifest["folders"]) + len(manifest["retired"])
    # A batch run again once it is merged changes nothing; the newest one, and one of a new checkpoint, count.
    again = spark.createDataFrame([("a", BASE, -1.0)], "station_id string, window_start timestamp, v double")
    merged = max(f["batch"] for f in manifest["folders"] if f["level"])
    sw.write_version(again, merged, out, "q")
    assert read() == want
    sw.write_version(again, 0, out, "another checkpoint")
    assert read() == want | {("a", BASE): -1.0} and sw.newest_stored(spark, out) == (1, 0)


def test_trailing_means_of_a_stream_equal_batch(spark):
    """Windows arrive in any order over batches, with nulls; every score follows the whole series."""
    import random
    rnd = random.Random(4)
    schema = "station_id string, window_start timestamp, " + ", ".join(f"{c} double" for c in STREAM_MEASURES)
    steps, tail, features = [], None, {}
    at = lambda m: BASE + dt.timedelta(minutes=5 * m)
    for i in range(5):
        steps.append([(s, at(4 * i + j + back), *[None if rnd.random() < .5 else rnd.random() for _ in STREAM_MEASURES])
                      for s in "ab" for j, back in ((0, 0), (1, -3 if i else 0), (2, 0), (3, 0))])
    final, medians = {}, spark.createDataFrame([(s, *[9.0] * len(STREAM_MEASURES)) for s in "ab"],
                                               "station_id string, " + ", ".join(f"_median_{c} double" for c in STREAM_MEASURES))
    for rows in steps:
        final |= {r[:2]: r for r in rows}
        batch = spark.createDataFrame(list({r[:2]: r for r in rows}.values()), schema)
        seen, renewed = ss.with_tail(batch, tail)
        tail = spark.createDataFrame(renewed.collect(), schema)
        made = stream_features(seen.drop("_again"), medians=medians).join(seen.filter("_again").select("station_id", "window_start"), ["station_id", "window_start"], "left_semi")
        features |= {(r.station_id, r.window_start): tuple(r[c] for c in STREAM_MEASURES) for r in made.collect()}
    whole = stream_features(spark.createDataFrame(list(final.values()), schema), medians=medians)
    want = {(r.station_id, r.window_start): tuple(r[c] for c in STREAM_MEASURES) for r in whole.collect()}
    assert features.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k in want for x, y in zip(features[k], want[k]))
    assert tail.groupBy("station_id").count().filter(f"count > {ss.TAIL}").count() == 0


def test_a_new_checkpoint_counts_as_newer(spark, tmp_path):
    out = str(tmp_path / "out")
    df = land(spark, tmp_path / "in", [("a", 1, 3), ("b", 1, 5)], "1")
    for i in range(2):
        sw.upsert_windows(sw.windowed(source(spark, tmp_path / "in", df.schema)), out, str(tmp_path / "s"), every=None).awaitTermination()
        land(spark, tmp_path / "in", [("a", 1, 3)], str(i))
    again = land(spark, tmp_path / "in2", [("a", 1, 99)], "1")
    sw.upsert_windows(sw.windowed(source(spark, tmp_path / "in2", again.schema)), out, str(tmp_path / "s2"), every=None).awaitTermination()
    got = {(r.station_id, r.window_start): r.pm25_avg for r in sw.read_windows(spark, out).collect()}
    assert {v for (s, _), v in got.items() if s == "a"} == {99.0}
    assert {v for (s, _), v in got.items() if s == "b"} == {5.0}
    day = sw.read_windows(spark, out, since="2024-01-02")
    assert day.count() == 0 and "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().toString()


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    schema = land(spark, tmp_path / "in", [("a", 5, 1), ("a", 60, 1)], "1").schema
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    agg = lambda: sw.windowed(source(spark, tmp_path / "in", schema), slide=None)
    sw.append_rows(agg(), out, state, every=None).awaitTermination()
    land(spark, tmp_path / "in", [("a", 6, 1), ("a", 61, 1)], "2")
    sw.append_rows(agg(), out, state, every=None).awaitTermination()
    rows = spark.read.parquet(out)
    assert minutes(rows, "window_start") == [("a", 0)]
    assert rows.first().record_count == 1


def test_event_lands_in_two_sliding_windows(spark, tmp_path):
    df = land(spark, tmp_path / "in", [("a", 7, 1)], "1")
    assert minutes(window_agg(df, "event_time"), "window_start", "window_end") == [("a", 0, 10), ("a", 5, 15)]
    assert minutes(window_agg(df, "event_time", slide=None), "window_start") == [("a", 0)]
    odd = window_agg(df, "event_time", "10 minutes", "4 minutes")
    assert minutes(odd, "window_start") == [("a", 0), ("a", 4)]


def test_sink_errors_fail_the_query(spark, tmp_path):
    schema = land(spark, tmp_path / "in", [("a", 5, 1)], "1").schema

    def sink(batch, batch_id):
        raise ValueError("no disk")

    q = sw.start(source(spark, tmp_path / "in", schema), sink, str(tmp_path / "s"), "append", None)
    with pytest.raises(Exception, match="no disk"):
        q.awaitTermination()


def test_decode_and_quarantine(spark):
    good = b'{"station_id":"A","timestamp":"2024-01-01T00:00:00.5Z","pm25":1.5,"precipitation_probability":3}'
    rows = [(good,), (b"{broken",), (b'{"timestamp":"2024-01-01T00:00:00Z"}',), (b'{"station_id":"A","timestamp":"x"}',)]
    ok, bad = dc.decode_payload(spark.createDataFrame(rows, "value binary"))
    r = ok.first()
    assert ok.count() == 1 and r.pm25 == 1.5 and r.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert bad.count() == 3
    assert dc.raw_projection(ok).first().precip_prob == 3.0


def test_stream_dedup(spark, tmp_path):
    schema = land(spark, tmp_path / "in", [("a", 1, 1), ("a", 1, 1), ("b", 1, 1)], "1").schema
    land(spark, tmp_path / "in", [("a", 1, 1)], "2")
    out = str(tmp_path / "out")
    unique = dedup_stream(source(spark, tmp_path / "in", schema), ["station_id", "event_time"], "event_time", "10 minutes")
    sw.append_rows(unique, out, str(tmp_path / "s"), every=None).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_alert_stream_keeps_spells_across_batches(spark, tmp_path):
    rule = [AlertRule("w", "v", 100, 30, "warning")]
    values = [150] * 4 + [50] + [150] * 12 + [150] * 3
    for i in range(0, len(values), 6):
        df = spark.createDataFrame(
            [("a", BASE + dt.timedelta(minutes=5 * j), float(values[j])) for j in range(i, min(i + 6, len(values)))],
            "station_id string, window_start timestamp, v double")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    fired = alert_stream(source(spark, tmp_path / "in", df.schema), rule)
    sw.append_rows(fired, str(tmp_path / "out"), str(tmp_path / "s"), every=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = sustained_alerts(spark.read.parquet(str(tmp_path / "in")), rule)
    assert minutes(got, "started_at", "fired_at") == [("a", 25, 55)]
    assert minutes(batch, "started_at", "ended_at") == [("a", 25, 95)]


def test_alert_stream_equals_batch_on_any_cut(spark, tmp_path):
    import random
    rnd = random.Random(8)
    rule = [AlertRule("w", "v", 100, 20, "warning")]
    at, rows = 0, []
    for _ in range(160):
        at += rnd.choice([5, 5, 5, 5, 20])
        rows.append(("a", BASE + dt.timedelta(minutes=at), rnd.choice([150.0, 150.0, 150.0, 50.0, None, float("nan")])))
    cuts = sorted(rnd.sample(range(1, 160), 9))
    for i, j in zip([0, *cuts], [*cuts, 160]):
        df = spark.createDataFrame(rows[i:j], "station_id string, window_start timestamp, v double")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    fired = alert_stream(source(spark, tmp_path / "in", df.schema), rule)
    sw.append_rows(fired, str(tmp_path / "out"), str(tmp_path / "s"), every=None).awaitTermination()
    batch = sustained_alerts(spark.read.parquet(str(tmp_path / "in")), rule)
    assert minutes(spark.read.parquet(str(tmp_path / "out")), "started_at") == minutes(batch, "started_at") != []


def test_progress_is_stored_per_batch(spark, tmp_path):
    df = land(spark, tmp_path / "in", [("a", m, 5) for m in range(30)] + [("a", 3, -7)], "1")
    land(spark, tmp_path / "in", [("a", m, 5) for m in range(200, 210)], "2")
    log = pg.ProgressLog(spark, str(tmp_path / "log"), every=1)
    state = str(tmp_path / "state")
    try:
        for files in (None, [("a", 1, 5), ("b", 2, 5)]):
            if files:
                land(spark, tmp_path / "in", files, "3")
            agg = sw.windowed(pg.observed_valid(source(spark, tmp_path / "in", df.schema)))
            q = sw.upsert_windows(agg, str(tmp_path / "out"), state, every=None)
            sw.await_any([q])
            log.wait(q.runId)
    finally:
        log.close()
    rows = pg.read_progress(spark, str(tmp_path / "log")).collect()
    assert len({(r.query_id, r.run_id) for r in rows}) == 2
    assert sum(r.rows_in or 0 for r in rows) == 43 and sum(r.quarantined or 0 for r in rows) == 1
    assert sum(r.late for r in rows) > 0 and all(r.batch_ms >= 0 for r in rows)


def test_one_failing_stream_stops_the_others(spark, tmp_path):
    df = land(spark, tmp_path / "in", [("a", 0, 1)], "1")

    def fail(batch, batch_id):
        raise ValueError("sink is gone")

    def start(sink, name):
        return sw.start(source(spark, tmp_path / "in", df.schema), sink, str(tmp_path / name), "append", every="1 second")

    good = start(lambda batch, batch_id: batch.count(), "good")
    bad = start(fail, "bad")
    with pytest.raises(Exception, match="sink is gone"):
        sw.await_any([good, bad])
    assert not good.isActive and not bad.isActive and good.exception() is None
