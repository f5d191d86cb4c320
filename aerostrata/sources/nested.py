"""Nested feed responses to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.functions.index import composite_index
from aerostrata.operators.joins import with_dimension
from aerostrata.schema import AIR_FIELDS, READINGS_CSV, WEATHER_FIELDS, hourly_response


def read_responses(spark: SparkSession, path: str, fields: dict[str, str],
                   key: str = "station_id") -> DataFrame:
    """Landed history responses, one JSON document per line, with the station each was asked for."""
    schema = T.StructType([T.StructField(key, T.StringType()), *hourly_response(fields).fields])
    return spark.read.schema(schema).json(path)


def history_readings(air: DataFrame, weather: DataFrame, stations: DataFrame) -> DataFrame:
    """History responses of both feeds as indexed readings in the layout of the CSV files."""
    hours = explode_hourly(air, weather, ["station_id"])
    rows = composite_index(with_dimension(hours, stations, ["station_id"]))
    return rows.select(*READINGS_CSV.fieldNames())


def explode_hourly(air: DataFrame, weather: DataFrame, keys: Sequence[str],
                   air_fields: dict[str, str] = AIR_FIELDS,
                   weather_fields: dict[str, str] = WEATHER_FIELDS) -> DataFrame:
    """One row per hour of the air feed, both feeds aligned by array position.

    The air feed's time array decides the number of rows: shorter or missing arrays give
    nulls, longer ones are cut.  A key missing in either feed, or with an empty time array
    in either, gives no rows.
    """
    a = air.select(*keys, F.col("hourly").alias("_a")).filter(F.size("_a.time") > 0)
    b = weather.select(*keys, F.col("hourly").alias("_b")).filter(F.size("_b.time") > 0)
    none = F.array().cast("array<double>")
    arrays = [F.coalesce(F.col(f"_a.{f}"), none) for f in air_fields]
    arrays += [F.coalesce(F.col(f"_b.{f}"), none) for f in weather_fields]
    names = ["tanggal", *air_fields.values(), *weather_fields.values()]
    # Zipping pads to the longest array, hence the cut; only the keys ride along the rows.
    hours = F.slice(F.arrays_zip("_a.time", *arrays), F.lit(1), F.size("_a.time"))
    return a.join(b, list(keys)).select(*keys, F.inline(hours).alias(*names))


def current_values(df: DataFrame, keys: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Snapshot response (a struct `current` of scalars) with canonical names."""
    known = set(df.schema["current"].dataType.fieldNames())
    return df.select(*keys, *[
        (F.col(f"current.{f}") if f in known else F.lit(None)).cast("double").alias(n)
        for f, n in fields.items()
    ])
