"""Batch sources: reading files, station dimension, database tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.schema import READINGS_CSV, STATIONS_JSON


def read_readings_csv(spark: SparkSession, path: str | Sequence[str],
                      schema: T.StructType = READINGS_CSV) -> DataFrame:
    """All `.csv` files below a path in one scan, other files ignored, bad numbers null.

    A path without matching files gives an empty frame with the schema.
    """
    return (
        spark.read.schema(schema).option("header", True).option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True).option("ignoreMissingFiles", True).csv(path)
    )


def read_stations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Station dimension from nested configuration documents, one per file or one per line."""
    doc = spark.read.schema(STATIONS_JSON).option("multiLine", multi_line).json(path)
    return doc.select(F.inline("stations")).withColumnsRenamed(
        {"id": "station_id", "name": "station_name"})


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               bounds: tuple[str, str] | None = None, partitions: int = 32,
               properties: dict[str, str] | None = None) -> DataFrame:
    """Database table; filters and column lists applied to the result are pushed down.

    With a partition column and bounds it is read in parallel ranges instead of by one task.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", 10000).options(**(properties or {}))
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column) \
            .option("lowerBound", bounds[0]).option("upperBound", bounds[1]) \
            .option("numPartitions", partitions)
    return reader.load()
