"""Message decoding for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.functions.scalars import parse_ts
from aerostrata.schema import PAYLOAD


def read_stream(spark: SparkSession, fmt: str = "kafka", schema: T.StructType | None = None,
                **options: str) -> DataFrame:
    """Streaming source.  Kafka starts at the newest offsets and outlives lost segments."""
    if fmt == "kafka":
        options = {"startingOffsets": "latest", "failOnDataLoss": "false"} | options
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def decode_payload(messages: DataFrame, schema: T.StructType = PAYLOAD
                   ) -> tuple[DataFrame, DataFrame]:
    """Flat rows with `event_time`, and the messages that are no usable reading.

    A reading needs well-formed JSON, a station and a parsable timestamp.
    """
    doc = F.from_json(F.col("value").cast("string"), schema)
    parsed = messages.withColumn("_p", doc).withColumn("event_time", parse_ts(F.col("_p.timestamp")))
    usable = F.col("_p.station_id").isNotNull() & F.col("event_time").isNotNull()
    good = parsed.filter(usable).select("_p.*", "event_time")
    bad = parsed.filter(~F.coalesce(usable, F.lit(False))).select(*messages.columns)
    return good, bad


def raw_projection(decoded: DataFrame) -> DataFrame:
    """Columns of the raw table: the time as a timestamp, and its name for the rain probability.

    Rows without station or time are left out.
    """
    known = decoded.filter(F.col("station_id").isNotNull() & F.col("event_time").isNotNull())
    return known.withColumn("timestamp", F.col("event_time")).drop("event_time").withColumnRenamed(
        "precipitation_probability", "precip_prob")
