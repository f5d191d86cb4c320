"""Sustained-threshold alerts, station report and gauge values."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.index import decode_label
from aerostrata.functions.scalars import lookup, percent_text, round_half_up
from aerostrata.operators.joins import latest
from aerostrata.schema import CATEGORY_ICONS


class AlertRule(NamedTuple):
    """Fires when `column` stays above `threshold` at every sample for `minutes`."""

    name: str
    column: str
    threshold: float
    minutes: int
    severity: str


# The alert rules.
ALERT_RULES = [
    AlertRule("ISPUCritical", "ispu_avg", 200, 30, "critical"),
    AlertRule("ISPUWarning", "ispu_avg", 100, 60, "warning"),
    AlertRule("HighPM25", "pm25_avg", 55.4, 60, "warning"),
]


# Shortest length of the chunks a series may be cut into.
CHUNK_LENGTHS = {"hour": pd.Timedelta(hours=1), "day": pd.Timedelta(days=1), "week": pd.Timedelta(days=7),
                 "month": pd.Timedelta(days=28), "year": pd.Timedelta(days=365)}


def exceeds(value: Column, threshold: float) -> Column:
    """Whether a value is above the threshold; null and NaN are not."""
    return F.coalesce((value > float(threshold)) & ~F.isnan(value), F.lit(False))


def sustained_alerts(df: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES,
                     key: str = "station_id", time: str = "window_start",
                     max_gap: str = "5 minutes", chunk: str = "day") -> DataFrame:
    """Spells in which a rule's condition held without a break, as long as the rule asks.

    A false sample or a pause longer than `max_gap` ends a spell.  Spells are found inside
    (station, chunk), so a busy station is spread over its chunks, and all rules share
    that one shuffle.  Only spells touching a chunk's border can continue in the next
    chunk; at most two per chunk, they are joined up in a second, small step.
    """
    if pd.Timedelta(max_gap) >= CHUNK_LENGTHS[chunk]:
        raise ValueError("max_gap must be shorter than a chunk")
    gap = F.expr(f"interval {max_gap}")
    base = df.select(key, F.col(time).alias("_t"),
                     F.date_trunc(chunk, F.col(time)).alias("_chunk"),
                     *sorted({r.column for r in rules}))
    w = Window.partitionBy(key, "_chunk").orderBy("_t")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    flags = base.withColumns({
        "_prev": F.lag("_t").over(w),
        "_first": F.min("_t").over(whole), "_last": F.max("_t").over(whole),
        **{f"_on_{i}": exceeds(F.col(r.column), r.threshold)
           for i, r in enumerate(rules)},
    })
    paused = F.col("_prev").isNull() | (F.col("_t") - F.col("_prev") > gap)
    opens = flags.withColumns({
        f"_open_{i}": (F.col(f"_on_{i}") & (paused | ~F.lag(f"_on_{i}").over(w))).cast("int")
        for i in range(len(rules))
    })
    runs = opens.withColumns({
        f"_run_{i}": F.sum(f"_open_{i}").over(w.rowsBetween(Window.unboundedPreceding, 0))
        for i in range(len(rules))
    })
    samples = runs.select(key, "_chunk", "_t", "_first", "_last", F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                 F.lit(r.minutes).alias("_need"), F.col(f"_on_{i}").alias("_on"),
                 F.col(f"_run_{i}").alias("_run"), F.col(r.column).alias("_v"))
        for i, r in enumerate(rules)
    ]))).filter("_on")
    group = [key, "rule", "severity", "_need"]
    spells = samples.groupBy(*group, "_chunk", "_run").agg(
        F.min("_t").alias("started_at"), F.max("_t").alias("ended_at"),
        F.max("_v").alias("peak"), F.count(F.lit(1)).alias("samples"),
        F.first("_first").alias("_first"), F.first("_last").alias("_last"),
    ).withColumns({"_head": F.col("started_at") == F.col("_first"),
                   "_tail": F.col("ended_at") == F.col("_last")})

    # Border spells of a series share one lane, the others stay in their chunk's own lane.
    lane = F.when(~F.col("_head") & ~F.col("_tail"), F.col("_chunk"))
    spells = spells.withColumn("_lane", lane)
    lanes = [*group, "_lane"]
    bw = Window.partitionBy(*lanes).orderBy("started_at")
    continues = (
        F.col("_head") & F.lag("_tail").over(bw)
        & (F.col("started_at") - F.lag("ended_at").over(bw) <= gap)
        & (F.lag("_chunk").over(bw) != F.col("_chunk"))
    )
    joined = (
        spells.withColumn("_new", (~F.coalesce(continues, F.lit(False))).cast("int"))
        .withColumn("_run", F.sum("_new").over(bw.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*lanes, "_run")
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
             F.max("peak").alias("peak"), F.sum("samples").alias("samples"))
    )
    minutes = F.expr("timestampdiff(SECOND, started_at, ended_at)") / 60.0
    return (
        joined.select(*group, "started_at", "ended_at", "peak", "samples")
        .withColumn("minutes", minutes)
        .filter(F.col("minutes") >= F.col("_need")).drop("_need")
    )


# Texts of the report.
TODAY, TOMORROW, INDEX_OPEN, SURE_OPEN, CLOSE = "Sekarang:", "Besok:", "(ISPU ", "(keyakinan ", ")"
NO_READING = "Tidak ada data ISPU untuk hari ini."


def station_report(daily: DataFrame, predictions: DataFrame, day: Column,
                   regions: dict[str, str], icons: dict[str, str] = CATEGORY_ICONS) -> DataFrame:
    """One text row per station with a reading on `day` and its newest prediction, or one
    row saying there is none."""
    newest = latest(predictions, ["station_id"], [F.desc("created_at"), F.desc("event_id")]
                    if "event_id" in predictions.columns else [F.desc("created_at")])
    newest = newest.select("station_id", decode_label(F.col("predicted_label")).alias("predicted"),
                           "confidence")
    today = daily.filter(F.col("date") == day).select(
        "station_id", "ispu", F.col("aqi_category").alias("category"))
    region = lookup(regions, F.col("station_id"), F.col("station_id"))
    now_text = F.concat_ws(" ", F.lit(TODAY), lookup(icons, F.col("category"), F.lit("")),
                           F.col("category"),
                           F.concat(F.lit(INDEX_OPEN), round_half_up(F.col("ispu"), 0).cast("int"),
                                    F.lit(CLOSE)))
    next_text = F.when(F.col("predicted").isNotNull(), F.concat_ws(
        " ", F.lit(TOMORROW), lookup(icons, F.col("predicted"), F.lit("")), F.col("predicted"),
        F.concat(F.lit(SURE_OPEN), percent_text(F.col("confidence")), F.lit(CLOSE))))
    report = today.join(newest, "station_id", "left").select(
        "station_id", region.alias("region"), "category", "ispu", "predicted", "confidence",
        F.concat_ws("\n", region, now_text, next_text).alias("text"))
    spark = daily.sparkSession
    none = spark.range(1).select(
        F.lit(None).cast("string").alias("station_id"),
        F.lit(NO_READING).alias("text"),
    ).filter(~today.select(F.lit(1)).limit(1).exists())
    return report.unionByName(none, allowMissingColumns=True)


def latest_gauges(df: DataFrame, measures: Sequence[str], key: str = "station_id",
                  time: str = "window_start") -> DataFrame:
    """Values at each station's newest time, ties kept, nulls as 0."""
    return latest(df, [key], [F.desc(time)], ties=True).select(
        key, time, *measures).fillna(0, subset=list(measures))
