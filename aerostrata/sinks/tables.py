"""Sinks: partitioned Parquet, CSV, JDBC, Kafka messages, stored predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from aerostrata.operators.joins import insert_if_absent
from aerostrata.schema import READINGS_CSV
from aerostrata.session import materialized


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("date",),
                      replace_all: bool = False) -> None:
    """Parquet partitioned by date, replacing only the dates present in `df`.

    Rows are first brought together by partition value, which gives few files per
    partition; an oversized date is split again by adaptive execution.
    """
    df.hint("rebalance", *by).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic") \
        .partitionBy(*by).parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at `path`, or None if there is none; any other error is one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_absent(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column],
                  by: Sequence[str] = ("date",)) -> None:
    """Append the rows whose key the table at `path` does not hold yet; may be run again.

    The partitions that gain rows are staged with what they hold already and then replaced, so an append that is repeated, or
    that follows one which failed half way, leaves one row per key. The first of `by` must be among
    the keys: of the stored table only partitions between the lowest and highest value in `new`
    are read. `new` is computed once. Writers of the same partitions must take turns.
    """
    spark = new.sparkSession
    new = materialized(new)
    stored = read_or_none(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], new.schema)
    elif by and by[0] in keys:
        ends = new.agg(F.min(by[0]).alias("low"), F.max(by[0]).alias("high"))
        low, high = (ends.select(c).scalar() for c in ("low", "high"))
        stored = stored.filter(F.col(by[0]).between(low, high) | F.col(by[0]).isNull())
    if not by:
        insert_if_absent(new, stored, keys, order).write.mode("append").parquet(path)
        return
    added = materialized(insert_if_absent(new, stored, keys, order))
    touched = added.select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    held = stored.join(touched, same, "left_semi").select(*added.columns)
    write_partitioned(materialized(added.unionByName(held)), path, by)


def write_readings_csv(df: DataFrame, path: str) -> None:
    """Readings with header and fixed column order; a missing value is an empty field."""
    df.select(*READINGS_CSV.fieldNames()).write.mode("overwrite").option("header", True) \
        .option("emptyValue", "").option("nullValue", "").csv(path)


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Options of a batched JDBC append."""
    return {"url": url, "dbtable": table, "batchsize": "10000",
            "isolationLevel": "READ_COMMITTED", **extra}


def jdbc_append(df: DataFrame, url: str, table: str, writers: int = 16, **extra: str) -> None:
    """Append to a database table with a bounded number of connections; no rows, no change.

    The rows are shuffled to the writers, so computing them keeps its own parallelism.
    """
    df.repartition(writers).write.format("jdbc").options(**jdbc_options(url, table, **extra)) \
        .mode("append").save()


def to_kafka_json(df: DataFrame, key: str = "station_id") -> DataFrame:
    """Messages with the row as a JSON object; nulls are written, not left out."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def write_predictions(scored: DataFrame, path: str, version: str) -> None:
    """Append scored rows with the model version and the time of writing."""
    scored.withColumns({"model_version": F.lit(version), "created_at": F.current_timestamp()}) \
        .write.mode("append").parquet(path)
