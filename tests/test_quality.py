"""Cleaning, validation, expectations and audits on small edge tables."""

import datetime as dt

from pyspark.sql import functions as F

from aerostrata.operators import quality as ql
from aerostrata.schema import CLEANING_RULES, RangeRule

RULE = [RangeRule("pm25", 0, 500)]


def frame(spark, values, name="pm25"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} double")


def ids(df):
    return sorted(r.i for r in df.collect())


def test_strict_and_lenient_ranges(spark):
    df = frame(spark, [None, 0.0, 500.0, 500.1, -0.1])
    assert ids(ql.clean_ranges(df, RULE)) == [1, 2]
    ok, bad = ql.validate_rows(df, RULE)
    assert ids(ok) == [0, 1, 2]
    assert {r.i: r.reasons for r in bad.collect()} == {3: ["pm25"], 4: ["pm25"]}


def test_nan_is_out_of_range(spark):
    df = frame(spark, [float("nan"), 1.0])
    assert ids(ql.clean_ranges(df, RULE)) == [1]
    assert ids(ql.validate_rows(df, RULE)[0]) == [1]


def test_cleaning_is_idempotent_and_one_job(spark):
    cols = [r.column for r in CLEANING_RULES]
    df = spark.range(300).select(*[((F.col("id") * (i + 3)) % 150 - 5).cast("double").alias(c)
                                   for i, c in enumerate(cols)])
    once = ql.clean_ranges(df)
    assert once.count() == ql.clean_ranges(once).count()
    report = {r.check: (r.rows_in, r.rows_removed) for r in ql.cleaning_report(df).collect()}
    assert report["any_present"] == (300, 0)
    assert 300 - sum(out for _, out in report.values()) == once.count()
    plan = ql.cleaning_report(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_expectations_match_the_recorded_suite(spark):
    rows = [(None,)] * 121 + [(600.0,)] * 2 + [(1.0,)] * 967
    df = spark.createDataFrame(rows, "value double")
    out = {r.expectation: r for r in ql.expectations(
        df, not_null=["value"], between=[RangeRule("value", 0, 500)], types={"value": "double"}).collect()}
    n, b = out["not_null:value"], out["between:value"]
    assert (n.element_count, n.unexpected_count, n.success) == (1090, 121, False)
    assert round(n.unexpected_percent, 4) == 11.1009
    assert round(b.unexpected_percent, 4) == 0.2064 and round(b.unexpected_percent_total, 4) == 0.1835
    assert out["type:value"].success
    s = ql.suite_summary(ql.expectations(df, not_null=["value"], between=[RangeRule("value", 0, 500)],
                                         types={"value": "double"})).first()
    assert (s.evaluated, s.successful, s.unsuccessful) == (3, 1, 2)
    top = ql.unexpected_values(df, RangeRule("value", 0, 500)).collect()
    assert [(r.value, r.n) for r in top] == [(600.0, 2)]


def test_audit_matches_suffixed_columns(spark):
    df = spark.createDataFrame([(1.0, 700.0), (None, 5.0)], "pm25_avg double, pm10_avg double")
    out = {r["rule"]: (r["column"], r["out_of_range"], r["passed"]) for r in ql.audit_ranges(df).collect()}
    assert out == {"pm25": ("pm25_avg", 0, True), "pm10": ("pm10_avg", 1, False)}


def test_profile_and_freshness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "ts date, v int")
    p = ql.profile_table(df, "ts").first()
    assert (p.row_count, p.null_dates, p.distinct_stations, p.column_count) == (0, None, None, 2)
    f = ql.freshness(df, "ts", "2024-01-01").first()
    assert f.latest is None and f.stale
    full = spark.createDataFrame([("2024-01-01",)], "ts string")
    assert not ql.freshness(full, "ts", "2024-01-03").first().stale
    assert ql.freshness(full, "ts", "2024-01-04").first().stale


def test_dedup_prunes_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 2).alias("k"), "id")
    out = ql.dedup(df, ["k"], [F.asc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 0), (1, 1)]
    assert plan.count("WindowGroupLimit") == 2


def test_retention(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-31",)], "d string").select(F.to_date("d").alias("d"))
    assert ql.retention(df, "d", "2024-03-31", 90).count() == 2
    assert ql.retention(df, "d", "2024-04-01", 90).count() == 1


def test_a_quality_run_reads_each_table_once(spark, tmp_path):
    spark.sql("select 'a' station_id, date'2024-01-01' date, -5.0 pm25_avg, 3.0 humidity").write.parquet(str(tmp_path / "t"))
    one, two = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "t")).drop("station_id").filter("pm25_avg > 0")
    run = ql.quality_run({"one": (one, "date"), "two": (two, "date")}, "2024-01-02")
    plan = run._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("Relation[") == 2 and "scalar-subquery" not in plan
    assert [tuple(r) for r in run.orderBy("table").collect()] == [
        ("one", 1, 0, 1, 4, 1, dt.date(2024, 1, 1), False), ("two", 0, None, None, 3, 0, None, True)]
