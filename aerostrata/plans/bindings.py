"""Projections of the benchmark tables onto the tables the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.functions.index import composite_index
from aerostrata.functions.scalars import computed_once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_k(events: DataFrame) -> DataFrame:
    return computed_once(events, k=F.get_json_object("props", "$.k").cast("int"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as sensor readings: one station per event type, measures from value and props."""
    return readings_from(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream, with its time as a timestamp for the watermark."""
    schema = table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return readings_from(raw).withColumn("event_time", F.col("ts").cast("timestamp"))


def readings_from(events: DataFrame) -> DataFrame:
    e = _with_k(events)
    cents = F.col("value").cast("decimal(18,2)")
    eid, uid, k = F.col("event_id"), F.col("user_id"), F.col("k")
    factor = F.expr("CASE day(ts) % 4 WHEN 0 THEN 0.25 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 5 END")
    return e.select(
        "event_id", "user_id",
        F.col("event_type").alias("station_id"),
        "ts",
        F.to_date("ts").alias("date"),
        "k",
        F.when(eid % 13 == 0, None).otherwise((cents * factor).cast("double")).alias("pm25"),
        (uid % 150).cast("double").alias("pm10"),
        (cents * 20).cast("double").alias("co"),
        F.when(eid % 41 == 0, 2500).otherwise(k).cast("double").alias("no2"),
        (k.cast("double") / 2.0).alias("so2"),
        F.when(eid % 37 == 0, F.lit(1100).cast("long")).otherwise(eid % 120).cast("double").alias("o3"),
        (k % 15 + 20).cast("double").alias("temperature"),
        F.when(eid % 23 == 0, k + 100).otherwise(k).cast("double").alias("humidity"),
        (uid % 40).cast("double").alias("wind_speed"),
        F.when(eid % 31 != 0, (eid % 7).cast("double") / 2.0).alias("precipitation"),
        k.cast("double").alias("cloud_cover"),
    )


def indexed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite_index(readings(spark, sf_dir))


def volume_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as readings, the largest table: one station per supplier, one day per ship date."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    raw = li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("station_id"),
        F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("date"),
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity") * 4).alias("pm25"),
        (F.col("l_partkey") % 500).cast("double").alias("pm10"),
        (price / 2).alias("co"),
        (F.col("l_orderkey") % 900).cast("double").alias("no2"),
        (F.col("l_orderkey") % 700).cast("double").alias("so2"),
        (F.col("l_partkey") % 1000).cast("double").alias("o3"),
        (F.col("l_quantity") - 10).alias("temperature"),
        (F.col("l_quantity") * 2).alias("humidity"),
        (F.col("l_tax") * 1000).alias("wind_speed"),
        (F.col("l_discount") * 100).alias("precipitation"),
        (F.col("l_discount") * 1000).alias("cloud_cover"),
    )
    return composite_index(raw)


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as a long daily table in the layout of the daily aggregate, with null measures."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    cents = F.col("o_custkey")
    base = o.select(
        F.col("o_orderpriority").alias("station_id"),
        F.to_date("o_orderdate").alias("date"),
        price.alias("price"), cents.alias("cust"), F.col("o_orderkey").alias("okey"),
    )
    g = base.groupBy("station_id", "date").agg(
        F.sum("price").alias("p"), F.sum("cust").alias("c"), F.sum("okey").alias("o"),
        F.count(F.lit(1)).alias("record_count"),
    )
    whole = F.floor("p").cast("long")
    return g.select(
        "station_id", "date",
        F.when(F.col("c") % 11 == 0, None).otherwise((whole % 6000).cast("double") / 10).alias("pm25_avg"),
        F.when(F.col("c") % 7 == 0, None).otherwise((F.col("c") % 600).cast("double")).alias("pm10_avg"),
        (whole % 40000).cast("double").alias("co_avg"),
        (F.col("o") % 1500).cast("double").alias("no2_avg"),
        (F.col("c") % 900).cast("double").alias("so2_avg"),
        (F.col("o") % 700).cast("double").alias("o3_avg"),
        ((whole % 4500).cast("double") / 10).alias("ispu"),
        (F.col("c") % 40).cast("double").alias("temperature_avg"),
        F.when(F.col("o") % 9 == 0, None).otherwise((F.col("o") % 100).cast("double")).alias("humidity_avg"),
        (F.col("c") % 30).cast("double").alias("wind_speed_avg"),
        ((F.col("o") % 50).cast("double") / 2).alias("precipitation_sum"),
        (F.col("c") % 100).cast("double").alias("cloud_cover_avg"),
        "record_count",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as stored predictions: class code, confidence and model version per event."""
    e = _with_k(table(spark, sf_dir, "events"))
    return e.select(
        "event_id",
        F.col("event_type").alias("station_id"),
        F.to_date("ts").alias("window_start"),
        (F.col("k") % 5).cast("string").alias("predicted_label"),
        (F.col("k").cast("double") / 100).alias("confidence"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        F.col("ts").alias("created_at"),
    )
