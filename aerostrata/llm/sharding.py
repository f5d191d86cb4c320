"""Shards by proportional stratified interleaving.

Rows of each source are put into a seeded order. A row's fractional rank, (rank - 1/2) / rows of the
source, spreads every source evenly over the unit interval; the order by fractional rank is then cut
into equal runs, so each shard holds every source in the mixture's proportion. The law is `rows`:
shard counts differ by one at most.

Ranks need no global sort: rows fall into buckets of about `per_bucket` by the leading bits of their
order key, bucket counts are summed up, and rows are numbered inside their bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import stored, table

SHARDS = 24
SEED = 10
PER_BUCKET = 1024


def _before(counts: DataFrame, bucket: str, name: str, *within: str) -> DataFrame:
    """Adds `before`: rows in smaller buckets (of the same `within`). counts: (within, bucket, n).

    Two levels: sums inside runs of 1,024 buckets, then over the runs, so that no window holds more
    than a thousandth of the buckets.
    """
    w = stored(counts.withColumn("_run", F.floor(F.col(bucket) / 1024)), f"{name}-counts")
    runs = w.groupBy(*within, "_run").agg(F.sum("n").alias("_n"))
    over = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    runs = stored(runs.withColumn("_runs", F.sum("_n").over(over.orderBy("_run").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
                  .drop("_n"), f"{name}-runs")
    inner = Window.partitionBy(*within, "_run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return (w.join(runs, [*within, "_run"]).withColumn("before", F.sum("n").over(inner) - F.col("n") + F.col("_runs"))
            .drop("_run", "_runs", "n"))


def _numbered(rows: DataFrame, counts: DataFrame, bucket: str, name: str, order: list[Column], *within: str) -> DataFrame:
    """Adds `rank` from 1: the place of each row in the order by bucket and `order`, per `within`."""
    before = stored(_before(counts, bucket, name, *within), f"{name}-before")
    inner = Window.partitionBy(*within, bucket).orderBy(*order)
    numbered = rows.withColumn("_place", F.row_number().over(inner))
    return (numbered.join(before, [*within, bucket])
            .withColumn("rank", F.col("before") + F.col("_place")).drop("before", "_place"))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, source: str = "source", key: str = "doc_id",
               text: str = "text", per_bucket: int = PER_BUCKET) -> DataFrame:
    """One row per document: key, size, text_crc32, shard, slot, and source as `_source`.

    size is 8 plus the UTF-8 bytes of the text; a null text has none and the checksum of an empty
    one. A null source is the source "". The seeded order depends on seed, key and text alone; equal
    rows are interchangeable. With fewer rows than shards some shards stay empty. An empty table gives
    an empty result; further columns are not read.
    """
    body = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "utf-8")
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
                       (F.octet_length(body) + 8).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = rows.withColumn("_order", F.xxhash64(F.lit(seed), "_key", "text_crc32", "size"))
    rows = stored(rows, "shard-rows")
    total = rows.count()
    buckets = max(1, -(-total // per_bucket))
    # The leading 32 bits of the order key, shifted to be positive, deal rows out in order.
    lead = F.shiftright("_order", 32) + (1 << 31)
    rows = rows.withColumn("_bucket", F.floor(lead * F.lit(buckets) / F.lit(1 << 32)).cast("bigint"))
    counts = rows.groupBy("_source", "_bucket").agg(F.count("*").alias("n"))
    ranked = _numbered(rows, counts, "_bucket", "shard-own", [F.col("_order"), F.col("_key"), F.col("text_crc32")], "_source")
    sizes = stored(rows.groupBy("_source").agg(F.count("*").alias("_of")), "shard-sources")
    ranked = stored(ranked.drop("_bucket"), "shard-ranked")
    placed = ranked.join(sizes, "_source").withColumn("_at", (F.col("rank") - 0.5) / F.col("_of")).drop("rank", "_of")
    placed = stored(placed.withColumn("_bucket", F.floor(F.col("_at") * buckets).cast("bigint")), "shard-placed")
    counts = placed.groupBy("_bucket").agg(F.count("*").alias("n"))
    order = [F.col("_at"), F.xxhash64(F.lit(seed), "_source"), F.col("_source"), F.col("_order"), F.col("_key"), F.col("text_crc32")]
    out = _numbered(placed, counts, "_bucket", "shard-all", order)
    shard = F.floor((F.col("rank") - 1) * shards / F.lit(max(1, total)))
    # The quotient of doubles may round up to the next shard; the exact product decides.
    shard = F.when(shard * total > (F.col("rank") - 1) * shards, shard - 1).otherwise(shard)
    out = out.withColumn("_shard", shard.cast("bigint"))
    start = F.ceil(F.col("_shard") * total / shards)
    start = F.when((start - 1) * shards >= F.col("_shard") * total, start - 1).otherwise(start)
    return out.select(F.col("_key").alias(key), "size", "text_crc32", F.col("_shard").cast("int").alias("shard"),
                      (F.col("rank") - 1 - start).cast("bigint").alias("slot"), "_source")


def op10_stratified_shards(spark, sf_dir):
    out = interleave(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("_source").alias("source"))
