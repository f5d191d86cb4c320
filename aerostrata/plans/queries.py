"""Registered queries: every operator bound to the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.functions import index as ix
from aerostrata.functions import scalars as sc
from aerostrata.functions import stats
from aerostrata.ml import metrics as mm
from aerostrata.operators import aggregate as ag
from aerostrata.operators import alerts as al
from aerostrata.operators import audit as au
from aerostrata.operators import features as fe
from aerostrata.operators import joins as jn
from aerostrata.operators import oversample as ov
from aerostrata.operators import quality as ql
from aerostrata.operators import series as se
from aerostrata.plans import bindings as bd
from aerostrata.schema import (
    AIR_FIELDS, BREAKPOINTS, CATEGORIES, CLUSTER_MEASURES, COUNT_STEPS, COVERAGE_STEPS,
    DAILY_MEASURES, INDEX_STEPS, LAGS, POLLUTANTS, ROLLINGS, STREAM_MEASURES,
    WEATHER_FIELDS, WORST_STEPS, RangeRule,
)
from aerostrata.ml import models as md
from aerostrata.session import materialized, run_path
from aerostrata.sinks import tables as sk
from aerostrata.sources import logs as lg
from aerostrata.sources import nested as ns
from aerostrata.sources import readings as rd
from aerostrata.streaming import alerts as sa
from aerostrata.streaming import progress as pg
from aerostrata.streaming import scoring as ss
from aerostrata.streaming import windows as sw

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-30 12:00:00"
AS_OF_DAY = "2024-01-30"
REGIONS = {"view": "North", "click": "South", "purchase": "East", "signup": "West"}

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


# --- shared stages -----------------------------------------------------------------

# Values of the benchmark tables have four decimals at most: with these the other engine's sums
# are met digit by digit.
EXACT, EXACT_ROLL = {"digits": 4}, {"digits": 6}


def landed(spark, sf):
    """Indexed readings with their day as text, which some rows lack."""
    r = bd.indexed_readings(spark, sf)
    return r.withColumn("tanggal", F.when(F.col("event_id") % 47 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).otherwise("broken"))


def clean(spark, sf):
    return ql.clean_readings(landed(spark, sf))


def daily(spark, sf):
    return ag.daily_agg(clean(spark, sf), **EXACT)


def valid(spark, sf):
    return ql.validate_rows(bd.indexed_readings(spark, sf))[0]


def windows(spark, sf):
    return ag.window_agg(valid(spark, sf), **EXACT)


def recent_windows(spark, sf, interval):
    """Windows that start in the look-back; the filter on the readings' time reaches the scan."""
    r = ag.since(valid(spark, sf), "ts", AS_OF, interval, until="10 minutes")
    return ag.since(ag.window_agg(r, **EXACT), "window_start", AS_OF, interval)


def stored_windows(spark, sf):
    """Windowed table as stored, for operators that read it more than once."""
    return materialized(windows(spark, sf))


def long_daily(spark, sf):
    d = bd.daily_series(spark, sf).withColumn("aqi_category", ix.category(F.col("ispu")))
    return materialized(d)


# --- index and scalar functions ----------------------------------------------------

@query
def sub_index(spark, sf):
    r = bd.readings(spark, sf)
    return r.select("event_id", *[ix.sub_index(F.col(c), BREAKPOINTS[c]).alias(f"{c}_index")
                                  for c in POLLUTANTS])


@query
def composite_index(spark, sf):
    return bd.indexed_readings(spark, sf).select("event_id", "ispu", "ispu_category")


@query
def category(spark, sf):
    label = ix.category(F.col("co"))
    return bd.readings(spark, sf).select(
        "event_id", label.alias("label"), ix.severity(label).alias("severity"))


@query
def dominant_pollutant(spark, sf):
    return bd.readings(spark, sf).select("event_id", ix.dominant().alias("dominant"))


@query
def calendar_features(spark, sf):
    r = bd.readings(spark, sf).select("event_id", "ts")
    both = sc.calendar_parts(F.col("ts")) | sc.calendar_parts(F.col("ts"), hour=True)
    return r.withColumns(both)


@query
def decode_label(spark, sf):
    raw = F.when(F.col("k") % 7 == 0, F.concat(F.lit("c"), F.col("k"))).when(
        F.col("k") % 7 == 1, F.lit("Sedang")).when(
        F.col("k") % 7 == 2, F.concat((F.col("k") % 5).cast("string"), F.lit(".0"))).otherwise(
        (F.col("k") % 8).cast("string"))
    return bd.readings(spark, sf).select("event_id", ix.decode_label(raw).alias("label"))


@query
def threshold_step(spark, sf):
    return bd.indexed_readings(spark, sf).select(
        "event_id",
        ix.threshold_step(F.col("ispu"), INDEX_STEPS).alias("index_step"),
        ix.threshold_step(F.col("ispu"), WORST_STEPS).alias("worst_step"),
        ix.threshold_step(F.col("precipitation"), COUNT_STEPS).alias("count_step"),
        ix.threshold_step(F.col("cloud_cover"), COVERAGE_STEPS).alias("coverage_step"))


@query
def parse_text(spark, sf):
    """Dates and times from text, some of it malformed; zone conversion; formatting."""
    e = bd.readings(spark, sf)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    text = F.when(F.col("k") % 10 == 0, F.concat(F.lit("x"), iso)).otherwise(iso)
    return e.select(
        "event_id", sc.parse_day(text).alias("day"),
        sc.parse_ts(text).cast("timestamp_ntz").alias("parsed"),
        F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Jakarta"), F.col("ts"))).alias("local_day"),
        sc.lookup(REGIONS, F.col("station_id"), F.col("station_id")).alias("region"),
        sc.percent_text(F.col("k") / 200).alias("share"),
        sc.params_text(F.concat(F.lit("{'max_depth': "), F.col("k"), F.lit(", 'trees': 100}"))).alias("params"))


# --- filters and data quality ------------------------------------------------------

@query
def any_present(spark, sf):
    return bd.readings(spark, sf).filter(ql.any_present(["pm25"])).select("event_id", "station_id")


@query
def clean_ranges(spark, sf):
    return ql.clean_ranges(bd.indexed_readings(spark, sf)).select("event_id", "station_id", "date", "pm25", "ispu")


@query
def cleaning_report(spark, sf):
    return ql.cleaning_report(bd.readings(spark, sf))


@query
def drop_incomplete(spark, sf):
    r = bd.indexed_readings(spark, sf)
    return ql.drop_incomplete(r, ["event_id", "station_id"]).select("event_id", "pm25")


@query
def payload_valid(spark, sf):
    return valid(spark, sf).select("event_id", "pm25", "ispu")


@query
def payload_rejects(spark, sf):
    bad = ql.validate_rows(bd.indexed_readings(spark, sf))[1]
    return bad.select("event_id", F.array_join("reasons", ",").alias("reasons"))


def _suite(spark, sf):
    r = bd.readings(spark, sf).withColumn(
        "k_text", F.when(F.col("k") % 50 == 0, F.lit("n/a")).otherwise(F.col("k").cast("string")))
    return ql.expectations(
        r, not_null=["pm25", "co"],
        between=[RangeRule("pm25", 0, 300), RangeRule("o3", 0, 1000)],
        numeric_text=["k_text"], types={"pm25": "double", "date": "string"})


@query
def expectations(spark, sf):
    return _suite(spark, sf).withColumns({
        c: sc.round_half_up(F.col(c), 4) for c in ("unexpected_percent", "unexpected_percent_total")})


@query
def expectation_summary(spark, sf):
    return ql.suite_summary(_suite(spark, sf)).withColumn(
        "success_percent", sc.round_half_up(F.col("success_percent"), 4))


@query
def expectation_sample(spark, sf):
    return ql.unexpected_values(bd.readings(spark, sf), RangeRule("pm25", 0, 60))


@query
def profile_table(spark, sf):
    return ql.profile_table(daily(spark, sf), "date")


@query
def audit_ranges(spark, sf):
    return ql.audit_ranges(bd.indexed_readings(spark, sf).drop("ispu_category"))


@query
def freshness(spark, sf):
    return ql.freshness(bd.readings(spark, sf), "ts", "2024-02-03")


@query
def dedup_readings(spark, sf):
    r = bd.readings(spark, sf).select("event_id", "station_id", "user_id", "date", "ts", "co")
    return ql.dedup(r, ["station_id", "user_id", "date"], [F.asc("ts"), F.asc("event_id")])


@query
def retention(spark, sf):
    o = bd.table(spark, sf, "orders")
    return ql.retention(o, "o_orderdate", "2001-08-01", 90).select("o_orderkey", "o_orderdate")


# --- aggregates and serving views --------------------------------------------------

@query
def daily_agg(spark, sf):
    return daily(spark, sf)


@query
def daily_agg_volume(spark, sf):
    """Clean and daily aggregate over the largest table."""
    return ag.daily_agg(ql.clean_readings(bd.volume_readings(spark, sf)), **EXACT)


@query
def sliding_agg(spark, sf):
    return windows(spark, sf)


@query
def tumbling_agg(spark, sf):
    return ag.window_agg(valid(spark, sf), slide=None, **EXACT)


@query
def mean_index_24h(spark, sf):
    return ag.mean_value(recent_windows(spark, sf, "24 hours"), "ispu_avg", **EXACT)


@query
def worst_station(spark, sf):
    recent = recent_windows(spark, sf, "24 hours")
    return ag.worst(recent, "ispu_avg", ["station_id", "window_start"]).select(
        "station_id", sc.round_half_up(F.col("ispu_avg"), 1).alias("value"))


@query
def unhealthy_station_count(spark, sf):
    recent = recent_windows(spark, sf, "24 hours")
    return ag.distinct_above(recent, "station_id", "ispu_avg", 100)


@query
def coverage_pct(spark, sf):
    recent = recent_windows(spark, sf, "24 hours")
    recent = recent.filter(F.col("window_start") < F.lit(AS_OF).cast("timestamp_ntz"))
    return ag.coverage_pct(recent, "window_start", by=["station_id"])


@query
def recorded_minutes(spark, sf):
    """Different minutes with a reading per station in several look-backs, all from the bitmaps stored for each day."""
    minute = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60)
    days = landed(spark, sf).withColumn("date", F.to_date("ts"))
    stored = materialized(ag.distinct_bitmaps(days, minute, ["station_id", "date"]))
    out = None
    for n in (1, 7, 30):
        one = ag.distinct_count(ag.lookback(stored, "date", AS_OF_DAY, n), ["station_id"]).withColumn("days", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out.withColumnRenamed("value", "minutes")


@query
def category_distribution(spark, sf):
    return ag.category_distribution(ag.lookback(daily(spark, sf), "date", AS_OF_DAY, 7))


@query
def category_share(spark, sf):
    return ag.category_share(daily(spark, sf))


@query
def station_list(spark, sf):
    return windows(spark, sf).select("station_id").distinct().orderBy("station_id")


@query
def index_series(spark, sf):
    recent = recent_windows(spark, sf, "7 days")
    return recent.select(F.col("window_start").alias("time"), "station_id", "ispu_avg").orderBy("time")


@query
def daily_pm25(spark, sf):
    recent = ag.lookback(daily(spark, sf), "date", AS_OF_DAY, 7)
    return recent.select("date", "station_id", "pm25_avg").orderBy("date")


@query
def lookback(spark, sf):
    return ag.lookback(daily(spark, sf), "date", AS_OF_DAY, 7).select("station_id", "date", "ispu")


@query
def long_series(spark, sf):
    recent = recent_windows(spark, sf, "24 hours")
    return ag.long_series(recent, "window_start", {"pm25_avg": "PM2.5", "pm10_avg": "PM10"})


@query
def weather_series(spark, sf):
    recent = ag.lookback(daily(spark, sf), "date", AS_OF_DAY, 7)
    return ag.long_series(recent, "date", {"temperature_avg": "Suhu", "humidity_avg": "RH"})


@query
def series_reducers(spark, sf):
    return ag.series_reducers(windows(spark, sf), "pm25_avg", F.col("window_start"), **EXACT)


@query
def heatmap_hour_day(spark, sf):
    return ag.heatmap_hour_day(windows(spark, sf), "window_start", "ispu_avg", **EXACT)


@query
def heatmap_histogram(spark, sf):
    out = ag.heatmap_histogram(windows(spark, sf), "window_start", "ispu_avg")
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query
def latest_predictions(spark, sf):
    p = bd.predictions(spark, sf)
    return ag.newest(
        p.withColumn("confidence", sc.round_half_up(F.col("confidence"), 2)),
        ["station_id", "window_start", "predicted_label", "confidence", "model_version"],
        [F.desc("window_start"), F.desc("event_id")])


@query
def latest_per_station(spark, sf):
    p = bd.predictions(spark, sf)
    return jn.latest(p, ["station_id"], [F.desc("created_at"), F.desc("event_id")])


@query
def latest_per_station_ties(spark, sf):
    """Newest day's orders per priority: every row sharing the newest time is kept."""
    o = bd.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("station_id"), F.col("o_orderdate").alias("window_start"),
        "o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    return jn.latest(o, ["station_id"], [F.desc("window_start")], ties=True).fillna(0, ["price"])


@query
def latest_gauges(spark, sf):
    return al.latest_gauges(windows(spark, sf), ["ispu_avg", "pm25_avg", "pm10_avg"])


@query
def table_summary(spark, sf):
    return ag.table_summary(bd.readings(spark, sf), "ts")


@query
def predicted_vs_actual(spark, sf):
    """The last seven days, as the panel shows them."""
    actual = ag.long_series(ag.lookback(daily(spark, sf), "date", AS_OF_DAY, 7), "date", {"ispu": "Aktual"})
    p = ag.lookback(bd.predictions(spark, sf), "window_start", AS_OF_DAY, 7).withColumn(
        "mid", ix.label_midpoint(ix.decode_label(F.col("predicted_label"))).cast("double"))
    return actual.unionByName(ag.long_series(p, "window_start", {"mid": "Prediksi"}))


# --- joins and stored tables -------------------------------------------------------

def _station_dim(spark, sf):
    return bd.readings(spark, sf).groupBy("station_id").agg(
        (F.min("event_id") / 1000.0).alias("latitude"), F.max("user_id").cast("double").alias("longitude"))


@query
def latest_map(spark, sf):
    newest = jn.at_latest(materialized(daily(spark, sf)), "date")
    return jn.with_dimension(newest, _station_dim(spark, sf), ["station_id"]).select(
        "latitude", "longitude", sc.round_half_up(F.col("ispu"), 1).alias("ispu"),
        "station_id", "aqi_category")


@query
def merge_feeds(spark, sf):
    """Snapshot per user and day: air measures from two thirds of the events, weather from the rest."""
    r = bd.readings(spark, sf)
    last = [F.desc("ts"), F.desc("event_id")]

    def feed(air, columns):
        rows = r.filter((F.col("event_id") % 3 != 0) == air).select("user_id", "date", "ts", "event_id", *columns)
        return jn.latest(rows, ["user_id", "date"], last).drop("ts", "event_id")

    return jn.merge_feeds(feed(True, ["pm25", "pm10", "co"]),
                          feed(False, ["temperature", "humidity"]), ["user_id", "date"])


@query
def insert_if_absent(spark, sf):
    """A stored table holding the first half of the month receives the whole month."""
    d = materialized(daily(spark, sf).select("station_id", "date", "ispu"))
    stored = d.filter(F.col("date") < F.lit("2024-01-16").cast("date"))
    new = d.withColumn("ispu", F.col("ispu") + 1)
    added = jn.insert_if_absent(new, stored, ["station_id", "date"], [F.asc("ispu")])
    return stored.withColumn("origin", F.lit("stored")).unionByName(
        added.withColumn("origin", F.lit("added")))


@query
def stored_daily(spark, sf):
    """Daily table written partitioned by date, appended to, and read back with pruning."""
    path = run_path(spark, "daily")
    d = materialized(daily(spark, sf).select("station_id", "date", "ispu", "record_count"))
    sk.write_partitioned(d.filter(F.col("date") < F.lit("2024-01-20").cast("date")), path)
    sk.append_absent(d.withColumn("ispu", F.col("ispu") + 1), path, ["station_id", "date"], [F.asc("ispu")])
    return spark.read.parquet(path).filter(F.col("date") >= F.lit("2024-01-15").cast("date")).select(
        "station_id", "date", "ispu", "record_count")


@query
def csv_roundtrip(spark, sf):
    path = run_path(spark, "csv")
    r = bd.indexed_readings(spark, sf)
    none = F.lit(None).cast("string")
    sk.write_readings_csv(r.select(
        "*", none.alias("station_name"), none.alias("region"), F.lit(1.5).alias("latitude"),
        F.col("event_id").cast("double").alias("longitude"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("tanggal")), path)
    back = rd.read_readings_csv(spark, path)
    return back.select(
        F.col("longitude").cast("long").alias("event_id"), "station_id",
        sc.parse_day(F.col("tanggal")).alias("date"), "pm25", "co", "ispu", "ispu_category", "precipitation")


@query
def payload_json(spark, sf):
    """Messages as JSON text, decoded again with the payload schema."""
    r = bd.readings(spark, sf).select("station_id", "event_id", F.col("k").alias("cloud_cover"),
                                      (F.col("k") % 3 == 0).alias("flag"))
    return sk.to_kafka_json(r.withColumn("gap", F.when(F.col("flag"), F.col("event_id"))))


@query
def hourly_explode(spark, sf):
    """Each event carries a nested history: parallel arrays of differing length, some absent."""
    e = bd.readings(spark, sf)
    steps = F.sequence(F.lit(0), F.col("k") % 24)
    stamp = F.transform(steps, lambda i: F.concat(
        F.col("date").cast("string"), F.lit("T"), F.lpad(i.cast("string"), 2, "0"), F.lit(":00")))

    def values(base, length):
        return F.slice(F.transform(steps, lambda i: base + i), F.lit(1), length)

    long = F.lit(24)
    air = e.select("event_id", F.struct(F.struct(
        stamp.alias("time"),
        values(F.col("co"), F.col("k") % 20).alias("pm2_5"),
        values(F.col("pm10"), long).alias("pm10"),
        F.when(F.col("k") % 5 != 0, values(F.col("co"), long)).alias("carbon_monoxide"),
        values(F.col("no2"), long).alias("nitrogen_dioxide"),
        values(F.col("so2"), long).alias("sulphur_dioxide"),
        values(F.col("o3"), long).alias("ozone")).alias("hourly")).alias("doc")).select("event_id", "doc.hourly")
    weather = e.filter(F.col("station_id") != "error").select("event_id", F.struct(
        stamp.alias("time"),
        values(F.col("temperature"), F.col("k") % 10).alias("temperature_2m"),
        values(F.col("humidity"), long).alias("relative_humidity_2m"),
        values(F.col("wind_speed"), long).alias("wind_speed_10m"),
        values(F.col("precipitation"), long).alias("precipitation"),
        values(F.col("cloud_cover"), long).alias("cloud_cover")).alias("hourly"))
    return ns.explode_hourly(air, weather, ["event_id"])


@query
def history_readings(spark, sf):
    """Landed responses of two feeds, one station per event, read back and turned into readings."""
    doc = _history(spark, sf)
    air, weather = run_path(spark, "air"), run_path(spark, "weather")
    doc.select("station_id", F.col("air").alias("hourly")).write.json(air)
    doc.filter("event_type <> 'error'").select("station_id", F.col("weather").alias("hourly")).write.json(weather)
    stations = doc.select(
        "station_id", F.concat(F.lit("Station "), "station_id").alias("station_name"),
        F.lit("North").alias("region"), F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"))
    out = ns.history_readings(ns.read_responses(spark, air, AIR_FIELDS), ns.read_responses(spark, weather, WEATHER_FIELDS), stations)
    return out.select("station_id", "station_name", "latitude", "tanggal", "pm25", "co", "ispu", "ispu_category", "temperature")


def _history(spark, sf):
    e = bd.readings(spark, sf)
    steps = F.sequence(F.lit(0), F.col("k") % 24)
    stamp = F.transform(steps, lambda i: F.concat(
        F.col("date").cast("string"), F.lit("T"), F.lpad(i.cast("string"), 2, "0"), F.lit(":00")))

    def values(base):
        return F.transform(steps, lambda i: (F.col(base) + i).cast("double"))

    return e.select(
        F.concat(F.lit("E"), F.col("event_id")).alias("station_id"), F.col("station_id").alias("event_type"),
        F.struct(stamp.alias("time"), *[values(b).alias(f) for f, b in {
            "pm2_5": "co", "pm10": "pm10", "carbon_monoxide": "co", "nitrogen_dioxide": "no2", "sulphur_dioxide": "so2", "ozone": "o3"}.items()]).alias("air"),
        F.struct(stamp.alias("time"), values("temperature").alias("temperature_2m")).alias("weather"))


@query
def station_dimension(spark, sf):
    """Suppliers written as one nested configuration document, read as the station dimension."""
    path = run_path(spark, "stations")
    one = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
                   F.col("s_nationkey").cast("string").alias("region"), F.col("s_acctbal").alias("latitude"), F.lit(1.0).alias("longitude"))
    city = bd.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("city")).agg(F.collect_list(one).alias("stations"))
    city.write.json(path)
    return rd.read_stations(spark, path, multi_line=False)


@query
def stored_predictions(spark, sf):
    """Predictions appended in two versions and read back."""
    path = run_path(spark, "predictions")
    p = bd.predictions(spark, sf).select("event_id", "station_id", "window_start", "predicted_label", "confidence")
    for version, odd in (("v0", 0), ("v1", 1)):
        sk.write_predictions(p.filter(F.col("event_id") % 2 == odd), path, version)
    return spark.read.parquet(path).filter(F.col("created_at").isNotNull()).drop("created_at")


@query
def uv_index_mean(spark, sf):
    r = landed(spark, sf).withColumn("uv_index", F.when(F.col("k") % 3 != 0, F.col("k") / 10))
    r = ql.clean_readings(r)
    return ag.daily_agg(r, **EXACT).select("station_id", "date", "uv_index_avg", "record_count")


@query
def quality_run(spark, sf):
    return ql.quality_run({"daily": (daily(spark, sf), "date"), "windows": (windows(spark, sf), "window_start")}, "2024-02-03")


@query
def metric_summary(spark, sf):
    """Runs of the audit log with what they counted."""
    o = bd.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("dag_id"), F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("rows_in"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") % 100).alias("written"))
    return au.metric_summary(o, {"in": "rows_in", "out": "written"})


METRIC_SCHEMA = T.StructType([T.StructField("rows", T.LongType()), T.StructField("ok", T.BooleanType())])


def _log_lines(spark, sf):
    """Run-log text derived from `events`: one file per user, lines in event order."""
    r = bd.readings(spark, sf)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    eid = F.col("event_id").cast("string")
    kind = F.col("k") % 8
    body = (
        F.when(kind == 0, F.concat(stamp, F.lit(" [INFO] etl - Batch ETL mulai")))
        .when(kind == 1, F.concat(stamp, F.lit(" [INFO] etl - Insert "), eid, F.lit(" baris")))
        .when(kind == 2, F.concat(stamp, F.lit(" [INFO] etl - Batch ETL selesai")))
        .when(kind == 3, F.concat(stamp, F.lit(" [INFO] ml - RF accuracy: 0."), F.col("k"), F.lit(", f1: 0."), F.col("user_id")))
        .when(kind == 4, F.concat(stamp, F.lit(" [WARNING] etl - range")))
        .when(kind == 5, F.concat(F.lit('__METRICS__:{"rows":'), eid, F.lit(',"ok":true}')))
        .when(kind == 6, F.lit("__METRICS__:{broken"))
        .otherwise(F.concat(F.lit("noise "), eid)))
    return r.select(F.concat(F.lit("run_"), F.col("user_id")).alias("file"),
                    F.col("event_id").alias("pos"), body.alias("text"))


@query
def log_metrics(spark, sf):
    return lg.extract_log_metrics(
        _log_lines(spark, sf), lg.ETL_PATTERNS + lg.TRAIN_PATTERNS[1:3], lg.ETL_MARKS)


@query
def metric_lines_first(spark, sf):
    return lg.parse_metric_lines(_log_lines(spark, sf), METRIC_SCHEMA, "first")


@query
def metric_lines_last(spark, sf):
    return lg.parse_metric_lines(_log_lines(spark, sf), METRIC_SCHEMA, "last")


# --- series and features -----------------------------------------------------------

@query
def lag_features(spark, sf):
    d = bd.daily_series(spark, sf).select("station_id", "date", *LAGS)
    return se.lag_features(d, LAGS)


@query
def lag_calendar(spark, sf):
    d = bd.daily_series(spark, sf).select("station_id", "date", "pm25_avg")
    return se.calendar_lags(d, {"pm25_avg": [1, 7]})


@query
def lag_readings(spark, sf):
    """Lags over single readings, where one station's series is as long as the data."""
    r = bd.readings(spark, sf).select("station_id", "ts", "event_id", "co")
    return se.lag_features(r, {"co": [1, 3]}, order=["ts", "event_id"], chunk="hour")


@query
def rolling_features(spark, sf):
    d = bd.daily_series(spark, sf).select("station_id", "date", "pm25_avg", "pm10_avg", "ispu")
    return se.rolling_features(d, ROLLINGS, **EXACT_ROLL)


@query
def impute_rolling_median(spark, sf):
    d = bd.daily_series(spark, sf).select("station_id", "date", "pm25_avg", "pm10_avg", "humidity_avg")
    return se.impute_rolling_median(d, ["pm25_avg", "pm10_avg", "humidity_avg"], **EXACT_ROLL)


@query
def group_medians(spark, sf):
    r = bd.readings(spark, sf)
    return se.group_medians(r, "station_id", ["pm25", "co"]).withColumnsRenamed(
        {"_median_pm25": "pm25", "_median_co": "co"})


@query
def ordinal_encode(spark, sf):
    return se.ordinal_encode(bd.readings(spark, sf).select("event_id", "station_id"))


@query
def batch_features(spark, sf):
    return fe.batch_features(materialized(bd.daily_series(spark, sf)), **EXACT_ROLL)


@query
def batch_features_scoring(spark, sf):
    return fe.batch_features(materialized(bd.daily_series(spark, sf)), impute=False, **EXACT_ROLL)


@query
def stream_features(spark, sf):
    return fe.stream_features(stored_windows(spark, sf), **EXACT_ROLL)


@query
def temporal_split(spark, sf):
    split = fe.temporal_split(fe.batch_features(long_daily(spark, sf)))
    return split.select("station_id", "date", "aqi_category", "split")


@query
def horizon_labels(spark, sf):
    d = long_daily(spark, sf).select("station_id", "date", "ispu", "aqi_category")
    return fe.with_horizon(d, 1)


@query
def class_weights(spark, sf):
    return fe.balanced_weights(bd.indexed_readings(spark, sf), "ispu_category")


@query
def station_means(spark, sf):
    means = fe.station_means(bd.daily_series(spark, sf), CLUSTER_MEASURES, **EXACT)
    return means.withColumns({c: sc.round_half_up(F.col(c), 4) for c in CLUSTER_MEASURES})


def _labelled(spark, sf):
    return bd.indexed_readings(spark, sf).select(
        F.col("ispu_category").alias("actual"),
        ix.decode_label((F.col("k") % 5).cast("string")).alias("guess"))


@query
def confusion_matrix(spark, sf):
    return mm.confusion_matrix(_labelled(spark, sf), "actual", "guess")


@query
def classification_metrics(spark, sf):
    return mm.classification_metrics(_labelled(spark, sf), "actual", "guess")


# --- stream twins, alerts, audit ---------------------------------------------------

@query
def json_decode(spark, sf):
    from aerostrata.streaming.decode import decode_payload
    good, _ = decode_payload(_messages(spark, sf))
    return good.select(
        F.col("longitude").cast("long").alias("event_id"), "station_id",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"), "pm25", "co", "weather_code")


@query
def json_quarantine(spark, sf):
    from aerostrata.streaming.decode import decode_payload
    _, bad = decode_payload(_messages(spark, sf))
    return bad.select(F.col("value").cast("string").alias("value"))


def _messages(spark, sf):
    """`events` as binary messages; some carry broken JSON or no station."""
    r = bd.readings(spark, sf)
    doc = F.to_json(F.struct(
        F.when(F.col("k") % 17 != 0, F.col("station_id")).alias("station_id"),
        F.col("event_id").cast("double").alias("longitude"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "pm25", "co", F.col("k").cast("double").alias("weather_code")))
    broken = F.concat(F.lit("{broken "), F.col("event_id"))
    gone = F.concat(F.lit('{"event":'), F.col("event_id"), F.lit("}"))
    text = F.when(F.col("k") % 19 == 0, broken).when(F.col("k") % 17 == 0, gone).otherwise(doc)
    return r.select(text.cast("binary").alias("value"))


@query
def late_events(spark, sf):
    o = bd.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return se.late_events(o, "o_orderkey", "o_orderdate", "365 days")


@query
def latest_window_version(spark, sf):
    """Windows first written from every valid reading, later rewritten from the clean ones."""
    from aerostrata.streaming.windows import latest_versions
    first = ag.window_agg(valid(spark, sf), **EXACT).withColumn("batch_id", F.lit(0).cast("long"))
    second = ag.window_agg(clean(spark, sf), **EXACT).withColumn("batch_id", F.lit(1).cast("long"))
    return latest_versions(first.unionByName(second)).select(
        "station_id", "window_start", "pm25_avg", "record_count", "batch_id")


@query
def sustained_alerts(spark, sf):
    return al.sustained_alerts(windows(spark, sf), max_gap="15 minutes")


@query
def station_report(spark, sf):
    return al.station_report(daily(spark, sf), bd.predictions(spark, sf),
                             F.lit(AS_OF_DAY).cast("date"), REGIONS)


def _audit_log(spark, sf):
    """`orders` as runs: a start row, and a finish row unless the order is pending."""
    o = bd.table(spark, sf, "orders")
    run = [F.col("o_orderpriority").alias("dag_id"), F.col("o_orderkey").cast("string").alias("run_id")]
    start = o.select(*run, F.lit("RUNNING").alias("status"), F.lit(0).cast("long").alias("records_in"),
                     F.col("o_orderdate").alias("event_time"))
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED")
    finish = o.filter("o_orderstatus <> 'P'").select(
        *run, status.alias("status"), F.col("o_custkey").alias("records_in"),
        F.expr("timestampadd(MINUTE, CAST(o_custkey % 240 AS INT), o_orderdate)").alias("event_time"))
    return start.unionByName(finish)


@query
def audit_latest(spark, sf):
    return au.latest_runs(_audit_log(spark, sf))


@query
def audit_duration(spark, sf):
    return au.run_durations(_audit_log(spark, sf))


@query
def audit_listing(spark, sf):
    return au.runs_like(au.latest_runs(_audit_log(spark, sf)), "1-%").select("dag_id", "status", "records_in")


@query
def run_summary(spark, sf):
    return au.run_summary(au.run_durations(_audit_log(spark, sf)))


@query
def run_counters(spark, sf):
    """Rows entering, surviving and leaving the daily job, counted while they pass."""
    raw, n_raw = au.observed(landed(spark, sf), "raw")
    kept, n_kept = au.observed(ql.clean_readings(raw), "clean",
                               max_ispu=F.max("ispu"))
    out, n_out = au.observed(ag.daily_agg(kept, **EXACT), "daily")
    sk.write_partitioned(out, run_path(spark, "counted"))
    row = [(n_raw.get["rows"], n_kept.get["rows"], n_out.get["rows"], n_kept.get["max_ispu"])]
    return spark.createDataFrame(row, "csv_rows long, after_clean long, daily_rows long, max_ispu double")


# --- documented analyses -----------------------------------------------------------

@query
def weekend_ttest(spark, sf):
    return ag.weekend_ttest(bd.daily_series(spark, sf), "date", "ispu", ["station_id"], **EXACT)


@query
def weekend_p_value(spark, sf):
    """How likely the difference of weekend and weekday is by chance: the t-test's p-value, to six digits."""
    p = stats.t_test_p(F.col("t"), F.col("dof"))
    return weekend_ttest(spark, sf).select("station_id", "t", "dof", (F.floor(p * 1e6 + 0.5) / 1e6).alias("p_value"))


@query
def oversampled_categories(spark, sf):
    """Readings of each category and the new ones that bring it to the largest; how many of these lie between two given ones."""
    rows = bd.indexed_readings(spark, sf).filter("ispu_category IS NOT NULL").select("ispu_category", "pm25", "pm10")
    out = ov.oversample(rows, "ispu_category", ["pm25", "pm10"])
    inside = F.lit(True)
    for i, c in enumerate(["pm25", "pm10"]):
        a, b = F.col("origin")[i], F.col("partner")[i]
        inside = inside & F.col(c).between(F.least(a, b) - 1e-9, F.greatest(a, b) + 1e-9)
    return out.groupBy("ispu_category").agg(
        F.count_if(~F.col("synthetic")).alias("given"), F.count_if("synthetic").alias("made"),
        F.count_if(F.col("synthetic") & inside).alias("between"), F.count_distinct("origin").alias("origins"))


@query
def station_ranking(spark, sf):
    from pyspark.sql import Window
    w = Window.partitionBy("date").orderBy(F.desc_nulls_last("ispu"))
    return daily(spark, sf).select("date", "station_id", "ispu").withColumn("rank", F.rank().over(w))


@query
def pollutant_weather_corr(spark, sf):
    return ag.correlations(clean(spark, sf), "pm25",
                           ["temperature", "humidity", "wind_speed", "precipitation"], ["station_id"])


@query
def idw_grid(spark, sf):
    u = F.col("user_id")
    points = clean(spark, sf).groupBy("user_id").agg(
        sc.round_half_up(sc.mean(F.col("pm25"), 4), 2).alias("pm25")).select(
        (u % 12 * 1.0 + 0.25).alias("longitude"), (F.floor(u / 12) * 1.0 + 0.25).alias("latitude"), "pm25")
    return ag.idw_grid(points, "pm25", 1.0, 2, digits=9)


# --- streams -----------------------------------------------------------------------

def _run(q):
    q.awaitTermination()


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _valid_stream(spark, sf):
    return ql.validate_rows(ix.composite_index(bd.events_stream(spark, sf)))[0]


@query
def training_guard(spark, sf):
    """For which least number of daily rows a training would start."""
    days = materialized(daily(spark, sf).select("station_id", "date"))
    least = [1, 50, 100, 1_000, 1_000_000_000]
    enough = [F.struct(F.lit(n).alias("minimum"), F.lit(fe.has_rows(days, n)).alias("starts")) for n in least]
    return days.agg(F.count("*").alias("rows")).select("rows", F.explode(F.array(*enough)).alias("g")).select("rows", "g.*")


@query
def empty_batches(spark, sf):
    """A stream without valid rows: its batches are read and stored nowhere."""
    path, seen = run_path(spark, "windows"), run_path(spark, "progress")
    log = pg.ProgressLog(spark, seen)
    try:
        rows = pg.observed_valid(ix.composite_index(bd.events_stream(spark, sf))).filter("pm25 < -1e9")
        q = sw.upsert_windows(sw.windowed(rows), path, run_path(spark, "empty-state"), every=None)
        sw.await_any([q])
        log.wait(q.runId)
    finally:
        log.close()
    folders = len(sw.read_manifest(spark, path)["folders"])
    return pg.read_progress(spark, seen).filter(F.col("run_id") == q.runId).agg(F.sum("rows_in").alias("rows_in"), F.lit(folders).alias("stored"))


@query
def stream_progress(spark, sf):
    """What the stored progress of a window stream says: rows counted and quarantined, late rows, batches timed."""
    path = run_path(spark, "progress")
    log = pg.ProgressLog(spark, path)
    try:
        rows = pg.observed_valid(ix.composite_index(bd.events_stream(spark, sf)))
        q = sw.upsert_windows(sw.windowed(rows), run_path(spark, "windows"), run_path(spark, "progress-state"), every=None)
        sw.await_any([q])
        log.wait(q.runId)
    finally:
        log.close()
    return pg.read_progress(spark, path).filter(F.col("run_id") == q.runId).agg(
        F.sum("rows_in").alias("rows_in"), F.sum("quarantined").alias("quarantined"), F.sum("late").alias("late"),
        F.bool_and(F.col("batch_ms") >= 0).alias("timed"))


@query
def raw_stream(spark, sf):
    """Messages decoded, projected and appended by a stream, and read back as the raw table."""
    from aerostrata.streaming import decode as dc
    landing, path = run_path(spark, "messages"), run_path(spark, "raw")
    _messages(spark, sf).write.parquet(landing)
    messages = dc.read_stream(spark, "parquet", schema=spark.read.parquet(landing).schema, path=landing)
    rows = dc.raw_projection(dc.decode_payload(messages)[0])
    _run(sw.append_rows(rows, path, run_path(spark, "raw-state"), every=None))
    out = _ntz(spark.read.parquet(path), "timestamp")
    return out.select(F.col("longitude").cast("long").alias("event_id"), "station_id", "timestamp", "pm25", "co",
                      F.lit(len(out.columns)).alias("columns"))


@query
def stream_sliding_agg(spark, sf):
    """Sliding windows kept up to date by a stream; the newest version of each window."""
    path = run_path(spark, "windows")
    agg = sw.windowed(_valid_stream(spark, sf), **EXACT)
    _run(sw.upsert_windows(agg, path, run_path(spark, "windows-state"), every=None))
    return _ntz(sw.read_windows(spark, path), "window_start", "window_end")


@query
def stream_alerts(spark, sf):
    """Alerts raised by a stream over its own closed windows."""
    closed, path = run_path(spark, "closed"), run_path(spark, "alerts")
    agg = sw.windowed(_valid_stream(spark, sf), **EXACT)
    _run(sw.append_rows(agg, closed, run_path(spark, "closed-state"), every=None))
    fired = sa.alert_stream(spark.readStream.schema(agg.schema).parquet(closed), max_gap="15 minutes")
    _run(sw.append_rows(fired, path, run_path(spark, "alerts-state"), every=None))
    return _ntz(spark.read.parquet(path), "started_at", "fired_at")


# --- models ------------------------------------------------------------------------

# The grid search of the registered query fits on about so many labelled rows.
GRID_ROWS = 2000


def _trained(spark, sf, **how):
    """Daily features split by time, and a forest fitted on the older part."""
    history = long_daily(spark, sf)
    medians = materialized(se.group_medians(history, "station_id", DAILY_MEASURES))
    rows = fe.batch_features(history, encode=False, medians=medians, **EXACT_ROLL)
    split = materialized(fe.temporal_split(rows))
    base = run_path(spark, "models")
    model = md.train_classifier(split.filter("split = 'train'").drop("split"), f"{base}/1", medians=medians, **how)
    return split, model, base


def _known(label):
    return F.coalesce(F.bool_and(F.col(label).isin(CATEGORIES)), F.lit(True))


def _sure(confidence="confidence"):
    return F.coalesce(F.bool_and(F.col(confidence).between(0, 1)), F.lit(True))


@query
def train_classifier(spark, sf):
    """The full grid search; what can be said of its result without knowing the trees."""
    split, model, base = _trained(spark, sf, max_rows=GRID_ROWS)
    fitted = md.read_summary(spark, f"{base}/1")
    scored = materialized(md.score(split.filter("split = 'test'"), model))
    labelled = mm.classification_metrics(scored, "aqi_category", "predicted_label")
    f1 = labelled.filter("label = 'weighted avg'").select("f1").scalar()
    return scored.agg(
        F.count("*").alias("test_samples"), F.lit(fitted["features"]).alias("features"),
        F.lit(len(fitted["fold_f1"])).alias("grid_points"), _known("predicted_label").alias("labels_known"),
        _sure().alias("confidence_in_range"), (f1 >= 0.9).alias("f1_high"),
        F.lit(all(0 <= x <= 1 for x in fitted["fold_f1"]) and set(fitted["best"]) == set(md.GRID)).alias("search_recorded"))


@query
def training_summary(spark, sf):
    split, model, _ = _trained(spark, sf, search=False)
    scored = materialized(md.score(split.filter("split = 'test'"), model))
    metrics = mm.classification_metrics(scored, "aqi_category", "predicted_label")
    clusters = _clusters(spark, sf)
    summary = md.training_summary(split, metrics, clusters)
    sizes = F.aggregate(F.transform(F.split("cluster_sizes", ","), lambda x: F.split_part(x, F.lit(":"), F.lit(2)).cast("long")),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return summary.select(
        "train_samples", "test_samples", sizes.alias("clustered"), F.size(F.split("cluster_sizes", ",")).alias("clusters"),
        *[F.col(c).between(0.9, 1).alias(f"{c}_high") for c in ("accuracy", "precision", "recall", "f1_score")])


@query
def batch_scores(spark, sf):
    """Newest day of every station scored with the stored model and the medians stored with it."""
    _, _, base = _trained(spark, sf, search=False)
    md.register_model(spark, base, 1, "Production", f"{base}/1", md.read_summary(spark, f"{base}/1"))
    model = md.load_model(spark, base)
    rows = fe.batch_features(long_daily(spark, sf), encode=False, medians=model.medians, **EXACT_ROLL)
    newest = jn.latest(rows, ["station_id"], [F.desc("date")])
    return md.score(newest, model).select(
        "station_id", "date", "pm25_avg", "pm10_avg", F.col("predicted_label").eqNullSafe(F.col("aqi_category")).alias("label_right"),
        F.col("confidence").between(0, 1).alias("confidence_in_range"), F.lit(model.version).alias("model_version"))


def _station_means(spark, sf):
    return materialized(fe.station_means(daily_agg_volume(spark, sf), CLUSTER_MEASURES))


def _clusters(spark, sf):
    return md.cluster_stations(_station_means(spark, sf))


@query
def station_clusters(spark, sf):
    """Clusters of stations: how many rows are nearer to another cluster's centre, in standard units."""
    c = materialized(_clusters(spark, sf))
    ones = c.agg(*[F.struct(F.avg(m).alias("m"), F.stddev(m).alias("s")).alias(m) for m in CLUSTER_MEASURES])
    scale = ones.first()
    z = {m: (F.col(m) - scale[m]["m"]) / (scale[m]["s"] or 1.0) for m in CLUSTER_MEASURES}
    centres = c.groupBy("cluster").agg(*[F.avg(z[m]).alias(m) for m in CLUSTER_MEASURES], F.avg("ispu").alias("index"))
    rows = centres.orderBy("cluster").collect()
    far = [sum((z[m] - r[m]) * (z[m] - r[m]) for m in CLUSTER_MEASURES) for r in rows]
    own = F.element_at(F.array(*far), F.col("cluster") + 1)
    return c.agg(
        F.count("*").alias("stations"), F.count_distinct("cluster").alias("clusters"),
        F.count_if(own > F.least(*far) * 1.0001 + 1e-9).alias("nearer_to_another"),
        F.lit(all(a["index"] <= b["index"] for a, b in zip(rows, rows[1:]))).alias("ranked_by_index"))


@query
def cluster_pca(spark, sf):
    """Properties that a projection onto two principal components has."""
    p = md.cluster_projection(_clusters(spark, sf))
    v1, v2 = F.var_samp("pc1"), F.var_samp("pc2")
    return p.agg(
        F.count("*").alias("stations"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).alias("uncorrelated"),
        (v1 >= v2).alias("ordered"), (v1 + v2 <= len(CLUSTER_MEASURES) + 1e-6).alias("within_total"))


@query
def stream_scores(spark, sf):
    """Windows scored by a stream in its micro-batches, against the same windows scored in batch."""
    medians = materialized(se.group_medians(stored_windows(spark, sf), "station_id", STREAM_MEASURES))
    train = fe.stream_features(stored_windows(spark, sf), medians=medians)
    train = train.withColumn("aqi_category", ix.category(F.col("ispu_avg")))
    train = materialized(train.dropna(subset=["aqi_category"]))
    base = run_path(spark, "stream-models")
    md.train_classifier(train, f"{base}/1", order=["window_start"], search=False, medians=medians)
    md.register_model(spark, base, 1, "Production", f"{base}/1", {})
    stored, scores = run_path(spark, "windows"), run_path(spark, "scores")
    agg = sw.windowed(_valid_stream(spark, sf), **EXACT)
    _run(ss.score_stream(agg, stored, scores, base, run_path(spark, "score-state"), every=None))
    live = sw.read_windows(spark, scores)
    model = md.load_model(spark, base)
    batch = ss.score_windows(sw.read_windows(spark, stored), model).select(
        "station_id", "window_start", F.col("predicted_label").alias("_label"), F.col("confidence").alias("_sure"))
    both = live.join(batch, ["station_id", "window_start"], "full")
    same = F.col("predicted_label").eqNullSafe(F.col("_label")) & (F.abs(F.col("confidence") - F.col("_sure")) < 1e-9)
    return both.agg(F.count("*").alias("windows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"),
                    _known("predicted_label").alias("labels_known"), F.min("model_version").alias("model_version"))


def all_queries() -> dict[str, Query]:
    """The registered queries; each first pins the session to UTC, the zone all times are in."""

    def in_utc(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        return run

    return {name: in_utc(fn) for name, fn in _queries.items()}
