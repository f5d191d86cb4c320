"""Run audit log, pipeline counters and run summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.operators.joins import latest

AUDIT = T.StructType([
    T.StructField("dag_id", T.StringType()), T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("records_in", T.LongType()),
    T.StructField("records_out", T.LongType()), T.StructField("error_msg", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])


def audit_event(spark: SparkSession, dag_id: str, run_id: str, status: str,
                records_in: int = 0, records_out: int = 0, error: str | None = None,
                at: dt.datetime | None = None) -> DataFrame:
    """One row for the append-only audit log; the message keeps its first 500 characters."""
    at = at or dt.datetime.now(dt.timezone.utc)
    return spark.createDataFrame(
        [(dag_id, run_id, status, records_in, records_out, error, at)], AUDIT
    ).withColumn("error_msg", F.left("error_msg", F.lit(500)))


def _phase(status: Column) -> Column:
    return F.when(status == "RUNNING", F.lit(0)).otherwise(F.lit(1))


def latest_runs(log: DataFrame) -> DataFrame:
    """Current state of every run; a finish beats a start at the same instant."""
    return latest(log, ["dag_id", "run_id"],
                  [F.desc(_phase(F.col("status"))), F.desc("event_time")])


def run_durations(log: DataFrame) -> DataFrame:
    """Start, finish and seconds per run, unfinished runs with a null finish."""
    done = _phase(F.col("status")) == 1
    return log.groupBy("dag_id", "run_id").agg(
        F.min("event_time").alias("started_at"),
        F.max(F.when(done, F.col("event_time"))).alias("finished_at"),
        F.max(F.when(done, F.col("status"))).alias("final_status"),
    ).withColumn("seconds", F.expr("timestampdiff(SECOND, started_at, finished_at)")) \
     .withColumn("status", F.coalesce("final_status", F.lit("RUNNING"))).drop("final_status")


def runs_like(log: DataFrame, pattern: str) -> DataFrame:
    return log.filter(F.col("dag_id").like(pattern))


def observed(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass; read the observation after the action has run."""
    obs = Observation(name)
    metrics = {"rows": F.count(F.lit(1)), **counters}
    return df.observe(obs, *[c.alias(n) for n, c in metrics.items()]), obs


def metric_summary(runs: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """One line of text per run from its metrics (label -> column); a missing metric is left out."""
    parts = [F.concat(F.lit(f"{label}="), F.col(c).cast("string")) for label, c in metrics.items()]
    head = F.concat(F.col("dag_id"), F.lit("/"), F.col("run_id"))
    return runs.select("dag_id", "run_id", F.concat_ws(" | ", head, F.col("status"), *parts).alias("summary"))


def run_summary(runs: DataFrame) -> DataFrame:
    """One line of text per run."""
    text = F.concat_ws(
        " | ", F.concat(F.col("dag_id"), F.lit("/"), F.col("run_id")), F.col("status"),
        F.concat(F.col("seconds").cast("string"), F.lit("s")))
    return runs.select("dag_id", "run_id", text.alias("summary"))
