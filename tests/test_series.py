"""Chunked series operators against brute force, with chunk borders in every position."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import aggregate as ag
from aerostrata.operators import features as fe
from aerostrata.operators import series as se
from aerostrata.operators.alerts import AlertRule, sustained_alerts


def daily(spark, values_by_station, start="2023-12-20", step=1):
    rows = [(s, i * step, v) for s, vs in values_by_station.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "station_id string, n int, v double").select(
        "station_id", F.date_add(F.lit(start).cast("date"), F.col("n")).alias("date"), "v")


def by_station(df, column, station="a"):
    return [r[column] for r in df.filter(F.col("station_id") == station).orderBy("date").collect()]


@pytest.mark.parametrize("chunk", ["week", "month", "year"])
def test_lags_cross_chunks_and_stations_stay_apart(spark, chunk):
    rnd = random.Random(1)
    data = {s: [rnd.choice([None, float(rnd.randint(0, 99))]) for _ in range(60)] for s in "ab"}
    for step in (1, 11):  # dense series, and one with whole chunks missing
        out = se.lag_features(daily(spark, data, step=step), {"v": [1, 3, 7]}, chunk=chunk)
        for s in "ab":
            for k in (1, 3, 7):
                want = [None] * k + data[s][:-k]
                assert by_station(out, f"v_lag_{k}", s) == want


@pytest.mark.parametrize("chunk", ["week", "year"])
def test_rolling_and_impute_match_brute_force(spark, chunk):
    rnd = random.Random(2)
    data = {s: [rnd.choice([None, None, float(rnd.randint(0, 99))]) for _ in range(50)] for s in "ab"}
    data["a"][0:9] = [None] * 9
    df = daily(spark, data)
    rolled = se.rolling_features(df, [("v", 3)], chunk=chunk)
    filled = se.impute_rolling_median(df, ["v"], chunk=chunk)
    for s in "ab":
        vs = data[s]

        def trailing(i, n):
            seen = [x for x in vs[max(0, i - n + 1):i + 1] if x is not None]
            return sum(seen) / len(seen) if seen else None

        med = statistics.median([x for x in vs if x is not None])
        want_roll = [trailing(i, 3) for i in range(len(vs))]
        want_fill = [x if x is not None else (trailing(i, 7) if trailing(i, 7) is not None else med)
                     for i, x in enumerate(vs)]
        for got, want in ((by_station(rolled, "v_roll_3", s), want_roll), (by_station(filled, "v", s), want_fill)):
            assert all((g is None and w is None) or abs(g - w) < 1e-6 for g, w in zip(got, want))


def test_small_values_are_not_quantised(spark):
    df = daily(spark, {"a": [0.00001, 0.00003, None]})
    assert abs(by_station(se.rolling_features(df, [("v", 2)]), "v_roll_2")[1] - 0.00002) < 1e-12
    assert by_station(se.rolling_features(df, [("v", 2)], digits=4), "v_roll_2")[1] == 0


def test_hand_values(spark):
    assert by_station(se.impute_rolling_median(daily(spark, {"a": [1.0, None, 3.0]}), ["v"]), "v") == [1, 1, 3]
    assert by_station(se.impute_rolling_median(daily(spark, {"a": [None, 4.0, 6.0]}), ["v"]), "v") == [5, 4, 6]
    assert by_station(se.rolling_features(daily(spark, {"a": [1.0, 2.0, 6.0, 10.0]}), [("v", 3)]),
                      "v_roll_3") == [1, 1.5, 3, 6]


def test_no_window_is_partitioned_by_the_station_alone_over_the_rows(spark):
    df = daily(spark, {"a": [1.0] * 5})
    plan = se.lag_features(df, {"v": [1]})._jdf.queryExecution().analyzed().toString()
    lagged = [line for line in plan.splitlines() if "lag(" in line]
    assert lagged and all("_chunk" in line for line in lagged)


def test_group_medians(spark):
    rnd = random.Random(3)
    groups = {"odd": [float(rnd.randint(0, 50)) for _ in range(101)],
              "even": [rnd.random() * 1e6 for _ in range(40)],
              "one": [3.5], "equal": [2.0] * 9, "two": [1.0, 1000.0],
              "many": [rnd.random() for _ in range(20_000)], "outlier": [rnd.random() for _ in range(20_000)] + [1e12],
              "ties": [float(rnd.randint(0, 3)) for _ in range(20_001)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in [*vs, None]], "station_id string, v double")
    got = {r.station_id: r._median_v for r in se.group_medians(df, "station_id", ["v"]).collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}


@pytest.mark.parametrize("gap", [1, 10**9])
def test_prefix_max_and_late_events(spark, gap):
    rnd = random.Random(4)
    vs = [rnd.randint(0, 100) for _ in range(97)]
    df = spark.createDataFrame([(i * gap, v) for i, v in enumerate(vs)], "i long, v int")
    out = [r.m for r in se.prefix_max(df, "i", "v", "m").orderBy("i").collect()]
    assert out == [None] + [max(vs[:i]) for i in range(1, len(vs))]


def test_calendar_lags_need_the_exact_day(spark):
    df = daily(spark, {"a": [1.0, 2.0, 3.0]}, step=2)
    out = se.calendar_lags(df, {"v": [1, 2]})
    assert by_station(out, "v_lag_1") == [None, None, None]
    assert by_station(out, "v_lag_2") == [None, 1.0, 2.0]


def test_ordinal_encode(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "station_id string")
    got = sorted((r.station_id, r.station_encoded) for r in se.ordinal_encode(df).collect())
    assert got == [("a", 0), ("a", 0), ("b", 1), ("c", 2)]


# --- sustained alerts --------------------------------------------------------------

def brute_alerts(samples, rule, gap):
    out, start, last, peak, n = [], None, None, None, 0
    for t, v in [*samples, (None, None)]:
        on = t is not None and v is not None and v > rule.threshold
        if start is not None and (not on or t - last > gap):
            if last - start >= rule.minutes:
                out.append((start, last, peak, n))
            start = None
        if on:
            start, peak, n = (t, v, 1) if start is None else (start, max(peak, v), n + 1)
            last = t
    return out


@pytest.mark.parametrize("chunk", ["hour", "day"])
@pytest.mark.parametrize("seed", [0, 1, 2])
def test_alerts_match_brute_force(spark, chunk, seed):
    rnd = random.Random(seed)
    t, samples = 0, []
    for _ in range(600):
        t += rnd.choice([5, 5, 5, 5, 10, 40])
        samples.append((t, rnd.choice([50.0, 150.0, 150.0, 150.0, 150.0, 250.0, None])))
    rules = [AlertRule("low", "v", 100, 30, "warning"), AlertRule("high", "v", 200, 0, "critical")]
    df = spark.createDataFrame([("a", m, v) for m, v in samples], "station_id string, m int, v double").select(
        "station_id", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, m, 0)").alias("window_start"), "v")
    got = sustained_alerts(df, rules, max_gap="15 minutes", chunk=chunk)
    base = "timestamp_ntz '2024-01-01 00:00:00'"
    for rule in rules:
        rows = got.filter(F.col("rule") == rule.name).selectExpr(
            f"timestampdiff(MINUTE, {base}, started_at) a", f"timestampdiff(MINUTE, {base}, ended_at) b",
            "peak", "samples").collect()
        assert sorted(tuple(r) for r in rows) == brute_alerts(samples, rule, 15)


def test_alert_needs_the_full_hour(spark):
    rule = [AlertRule("w", "v", 100, 60, "warning")]
    for n, want in ((13, 1), (12, 0)):
        df = spark.range(n).selectExpr("'a' station_id", "150.0D v",
                                       "timestamp_ntz '2024-01-01 23:30:00' + make_dt_interval(0, 0, CAST(id AS INT) * 5, 0) window_start")
        assert sustained_alerts(df, rule).count() == want


def test_temporal_split_and_weights(spark):
    df = daily(spark, {"a": [1.0] * 20}).withColumn("aqi_category", F.lit("Baik"))
    counts = {r.split: r["count"] for r in fe.temporal_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 13, "test": 7}
    w = spark.createDataFrame([("x",)] * 3 + [("y",)], "label string")
    assert {r.label: r.weight for r in fe.balanced_weights(w, "label").collect()} == {"x": 4 / 6, "y": 2.0}
    assert fe.has_rows(w, 4) and not fe.has_rows(w, 5)


def test_training_rows_follow_the_lag_depth(spark):
    """1,835 station-days lose five times seven lag rows and give 35 test rows."""
    df = daily(spark, {s: [1.0] * 367 for s in "abcde"}, start="2025-07-01")
    df = df.select("station_id", "date", *[F.col("v").alias(c) for c in fe.DAILY_MEASURES],
                   F.lit("Baik").alias("aqi_category"), F.lit(24).cast("long").alias("record_count"))
    counts = {r.split: r["count"] for r in
              fe.temporal_split(fe.batch_features(df)).groupBy("split").count().collect()}
    assert counts == {"train": 1765, "test": 35}


def test_bitmaps_count_like_distinct(spark):
    numbers = [0, 1, 1, 32767, 32768, 32769, 10 ** 12, -1, -32768, -40000, None]
    rows = [(k, d, n) for k in "ab" for d in range(3) for n in numbers if n is None or (n + d) % 3 or k == "a"] + [("gap", 0, None)]
    df = spark.createDataFrame(rows, "k string, d int, n long")
    bitmaps = ag.distinct_bitmaps(df, F.col("n"), ["k", "d"])
    for days in ([0], [0, 1], [0, 1, 2]):
        got = {r.k: r.value for r in ag.distinct_count(bitmaps.filter(F.col("d").isin(days)), ["k"]).collect()}
        assert got == {k: len({n for j, d, n in rows if j == k and d in days and n is not None}) for k in "ab"}
    total = len({n for _, _, n in rows if n is not None})
    assert ag.distinct_count(ag.merge_bitmaps(bitmaps, ["k"])).first().value == total
    assert ag.distinct_count(bitmaps.limit(0)).first().value == 0
