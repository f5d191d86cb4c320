"""Metrics mined from plain-text run logs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LogPattern(NamedTuple):
    """A regular expression whose group becomes a metric; the last matching line wins."""

    metric: str
    pattern: str
    dtype: str = "long"
    group: int = 1


# Log patterns, run marks and the prefix of metric lines.
TIMESTAMP = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
EXTRACT_PATTERNS = [LogPattern("rows", r"Batch Extract selesai.*total (\d+) rows")]
ETL_PATTERNS = [LogPattern("inserted", r"Insert (\d+) baris")]
TRAIN_PATTERNS = [
    LogPattern("loaded_rows", r"Loaded (\d+) rows"),
    LogPattern("accuracy", r"RF accuracy: ([\d.]+), f1: ([\d.]+)", "double", 1),
    LogPattern("f1", r"RF accuracy: ([\d.]+), f1: ([\d.]+)", "double", 2),
    LogPattern("train_samples", r"Train: (\d+)"),
]
PREDICT_PATTERNS = [
    LogPattern("loaded_rows", r"Loaded (\d+) rows"),
    LogPattern("predictions", r"Disimpan (\d+) prediksi"),
]
ETL_MARKS = ("Batch ETL mulai", "Batch ETL selesai")
TRAIN_MARKS = ("ML Training mulai", "ML Training selesai")
PREDICT_MARKS = ("Batch Predict mulai", "Batch Predict selesai")
VALIDATION_MARKS = ("Data Quality Check", "Quality Check selesai")
METRICS_PREFIX = "__METRICS__:"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and a position that orders the lines of one file.

    Large files are split; the block offset orders the splits and the running id the
    lines inside one.
    """
    lines = spark.read.text(path, recursiveFileLookup=True)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("line")).alias("pos"),
        F.col("value").alias("text"),
    )


def _match(text: Column, pattern: str, group: int) -> Column:
    """The pattern's group, null without a match: parsing an empty string is slow to fail."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _last(column: str) -> Column:
    """Value of the last line that has one."""
    value = F.col(column)
    return F.max_by(value, F.when(value.isNotNull(), F.col("pos"))).alias(column)


def extract_log_metrics(logs: DataFrame, patterns: list[LogPattern],
                        marks: tuple[str, str] | None = None) -> DataFrame:
    """One row per file: each pattern's last value, start and end time, success, warnings.

    `logs` has `file`, `pos` and `text`.  Every line is matched once, before the
    aggregation, and maxima by position combine map-side, so one very long log costs no
    more than many short ones.
    """
    text = F.col("text")
    found = {p.metric: _match(text, p.pattern, p.group).try_cast(p.dtype) for p in patterns}
    if marks:
        stamp = _match(text, TIMESTAMP, 1).try_cast("timestamp_ntz")
        found |= {name: F.when(text.contains(mark), stamp)
                  for name, mark in zip(("started_at", "ended_at"), marks)}
        found["ok"] = text.contains(marks[1])
    lines = logs.select("file", "pos", text.contains("WARNING").alias("warning"),
                        *[c.alias(n) for n, c in found.items()])
    aggs = [_last(n) for n in found if n != "ok"]
    aggs.append(F.count_if("warning").alias("warnings"))
    if not marks:
        return lines.groupBy("file").agg(*aggs)
    return lines.groupBy("file").agg(*aggs, F.max("ok").alias("ok")).withColumn(
        "seconds", F.expr("timestampdiff(SECOND, started_at, ended_at)"))


def parse_metric_lines(logs: DataFrame, schema: T.StructType,
                       pick: str = "first") -> DataFrame:
    """The first or last well-formed metric line of each file, parsed; others are skipped."""
    found = logs.filter(F.startswith(F.col("text"), F.lit(METRICS_PREFIX)))
    body = F.substr(F.col("text"), F.lit(len(METRICS_PREFIX) + 1))
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = found.withColumn("m", F.from_json(body, marked, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = parsed.filter(F.col("m").isNotNull() & F.col("m._bad").isNull())
    choose = F.min_by if pick == "first" else F.max_by
    names = [f.name for f in schema.fields]
    return good.groupBy("file").agg(choose("m", "pos").alias("m")).select(
        "file", *[F.col(f"m.{n}").alias(n) for n in names])
