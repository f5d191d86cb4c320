"""Index and scalar functions against hand-computed values."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostrata.functions import index as ix
from aerostrata.functions import scalars as sc
from aerostrata.schema import BREAKPOINTS, COVERAGE_STEPS, INDEX_STEPS


def column(spark, values, expr, dtype="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("pollutant,conc,want", [
    ("pm25", [None, -1.0, 0.0, 15.5, 55.4, 150.4, 250.4, 500.0, 600.0, 35.45, float("nan")],
     [None, 0, 0, 50, 100, 200, 300, 500, 500, 75, 0]),
    ("pm10", [100.0], [75]), ("so2", [116.0], [75]), ("co", [6000.0], [75]),
    ("o3", [177.5], [75]), ("no2", [140.0], [75]),
])
def test_sub_index(spark, pollutant, conc, want):
    got = column(spark, conc, lambda c: ix.sub_index(c, BREAKPOINTS[pollutant]))
    for g, w in zip(got, want):
        assert g is None if w is None else math.isclose(g, w, abs_tol=1e-9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-10, 2000), min_size=20, max_size=60))
def test_sub_index_is_monotone_and_bounded(spark, values):
    got = column(spark, sorted(values), lambda c: ix.sub_index(c, BREAKPOINTS["pm25"]))
    assert got == sorted(got) and all(0 <= g <= 500 for g in got)


def test_composite_index(spark):
    cols = "pm25 pm10 no2 so2 co o3"
    rows = [(15.5,) + (None,) * 5, (15.51,) + (None,) * 5, (35.45, 10.0) + (None,) * 4,
            (600.0,) + (None,) * 5, (None,) * 6]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, " + ", ".join(f"{c} double" for c in cols.split()))
    got = [(r.ispu, r.ispu_category) for r in ix.composite_index(df).orderBy("i").collect()]
    assert got == [(50.0, "Baik"), (50.0, "Sedang"), (75.0, "Sedang"), (500.0, "Berbahaya"), (None, None)]


def test_filter_on_index_keeps_one_copy_of_the_expression(spark):
    cols = ["pm25", "pm10", "no2", "so2", "co", "o3"]
    df = spark.range(10).select(*[F.col("id").cast("double").alias(c) for c in cols])
    plan = ix.composite_index(df).filter("ispu >= 0 AND ispu <= 500")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("greatest(") == 1


def test_category_and_labels(spark):
    values = [50.0, 50.01, 100.0, 200.0, 300.0, 300.01, None, float("nan")]
    assert column(spark, values, ix.category) == [
        "Baik", "Sedang", "Sedang", "Tidak Sehat", "Sangat Tidak Sehat", "Berbahaya", None, None]
    assert column(spark, ["4", "3.0", "Baik", "x", "9", None], ix.decode_label, "string") == [
        "Tidak Sehat", "Sedang", "Baik", "x", "9", None]
    assert column(spark, ["Baik", "Berbahaya", "?", None], ix.label_midpoint, "string") == [25, 400, 0, 0]
    assert column(spark, ["Baik", "Berbahaya"], ix.severity, "string") == [0, 4]


def test_threshold_step(spark):
    assert column(spark, [0.0, 50.0, 99.0, 300.0, None], lambda c: ix.threshold_step(c, INDEX_STEPS)) == [
        "green", "yellow", "yellow", "purple", "green"]
    assert column(spark, [89.0, 90.0], lambda c: ix.threshold_step(c, COVERAGE_STEPS)) == ["yellow", "green"]


def test_dominant(spark):
    df = spark.createDataFrame([(100.0, 10.0), (None, 10.0), (None, None)], "pm25 double, pm10 double")
    got = [r[0] for r in df.select(ix.dominant(["pm25", "pm10"])).collect()]
    assert got == ["pm25", "pm10", None]


def test_scalars(spark):
    r = spark.range(1).select(
        sc.round_half_up(F.lit(2.345), 2).alias("r"),
        sc.parse_day(F.lit("2024-01-06T10:00")).cast("string").alias("d"),
        sc.parse_day(F.lit("nonsense")).alias("nd"),
        sc.parse_ts(F.lit("bad")).alias("nt"),
        sc.lookup({"a": "A"}, F.lit("z"), F.lit("z")).alias("l"),
        sc.percent_text(F.lit(0.914)).alias("p"),
        sc.params_text(F.lit("{'a': 1, 'b': None}")).alias("c"),
        *[c.alias(n) for n, c in sc.calendar_parts(F.lit("2024-01-06").cast("date")).items()]).first()
    assert (r.r, r.d, r.nd, r.nt, r.l, r.p, r.c) == (
        2.35, "2024-01-06", None, None, "z", "91%", "a: 1 | b: None")
    assert (r.month, r.day_of_week, r.is_weekend, r.day_of_month) == (1, 5, 1, 6)


def test_mean_with_digits_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e6, -1e6, 7.77, None] * 40
    means = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        means.add(df.select(sc.mean(F.col("v"), 4)).first()[0])
    assert len(means) == 1


def plan(df):
    return df._jdf.queryExecution().toString()


def test_look_backs_reach_the_scan(spark):
    from aerostrata.plans.queries import recent_windows
    text = plan(recent_windows(spark, "/root/testdata/sf0.001", "24 hours"))
    pushed = text[text.rindex("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThanOrEqual(ts" in pushed


def test_small_values_are_not_quantised(spark):
    df = spark.createDataFrame([(0.00001,), (0.00003,)], "v double")
    assert abs(df.select(sc.mean(F.col("v"))).first()[0] - 0.00002) < 1e-12
    assert df.select(sc.mean(F.col("v"), 4)).first()[0] == 0


def test_append_reads_only_the_dates_of_the_new_rows(spark, tmp_path):
    from aerostrata.sinks import tables as sk
    day = lambda d: F.lit(d).cast("date").alias("date")
    old = spark.range(3).select(F.col("id").alias("station_id"), day("2024-01-01")).union(
        spark.range(3).select("id", day("2024-01-02")))
    path = str(tmp_path / "t")
    sk.append_absent(old, path, ["station_id", "date"], [F.asc("station_id")])
    sk.append_absent(spark.range(5).select(F.col("id").alias("station_id"), day("2024-01-02")), path,
                     ["station_id", "date"], [F.asc("station_id")])
    assert spark.read.parquet(path).count() == 8


def test_nan_is_no_alert(spark):
    from aerostrata.operators.alerts import exceeds
    df = spark.createDataFrame([(float("nan"),), (None,), (5.0,), (1.0,)], "v double")
    assert [r[0] for r in df.select(exceeds(F.col("v"), 2)).collect()] == [False, False, True, False]
