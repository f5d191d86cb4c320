"""Windowed aggregation of a stream and its idempotent sink."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostrata.operators.aggregate import window_agg
from aerostrata.operators.joins import latest

WINDOW_KEYS = ("station_id", "window_start")


def windowed(df: DataFrame, time_col: str = "event_time", watermark: str = "10 minutes",
             window: str = "10 minutes", slide: str | None = "5 minutes",
             digits: int | None = None) -> DataFrame:
    """Sliding (or tumbling) means of a stream; rows later than the watermark are dropped."""
    return window_agg(df.withWatermark(time_col, watermark), time_col, window, slide, digits=digits)


# --- store of window versions ----------------------------------------------------------
#
# <path>/data/level=L/run_id=R/batch_id=B/date=D holds the windows of one micro-batch (level 0) or of
# several merged ones; <path>/manifest/N.json names the folders that count. A manifest is written whole
# and never changed, so a reader sees either the folders before a merge or those after it.

# So many folders of one level become one of the next; a replaced folder or manifest stays for so many more writes.
MERGE, KEEP = 16, 32


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and its path type."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, make = _fs(spark, path)
    folder = make(f"{path}/manifest")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: number, run of every query, live folders and those that only slow readers still use."""
    found = _numbers(spark, path)
    if not found:
        return {"number": 0, "runs": {}, "folders": [], "retired": []}
    fs, make = _fs(spark, path)
    stream = fs.open(make(f"{path}/manifest/{found[-1]}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, manifest: dict) -> dict:
    """The manifest stored under the next number, in one rename; what nobody should read any more is deleted."""
    fs, make = _fs(spark, path)
    number = manifest["number"] + 1
    gone = [r for r in manifest["retired"] if r["at"] < number - KEEP]
    manifest = manifest | {"number": number, "retired": [r for r in manifest["retired"] if r not in gone]}
    part = make(f"{path}/manifest/{number}.part")
    out = fs.create(part, True)
    out.write(json.dumps(manifest).encode())
    out.close()
    if not fs.rename(part, make(f"{path}/manifest/{number}.json")):
        raise RuntimeError(f"another writer stored manifest {number} of {path}")
    for r in gone:
        fs.delete(make(f"{path}/data/{r['path']}"), True)
    for old in _numbers(spark, path):
        if old < number - KEEP:
            fs.delete(make(f"{path}/manifest/{old}.json"), False)
    return manifest


def newest_stored(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Highest (run, batch) in the store; None if nothing is stored."""
    return max(((f["run"], f["batch"]) for f in read_manifest(spark, path)["folders"]), default=None)


def _folder(level: int, run: int, batch: int) -> str:
    return f"level={level}/run_id={run}/batch_id={batch}"


def _store(rows: DataFrame, path: str, folder: str) -> None:
    """Rows brought together by date first: one file for each date they touch."""
    rows.withColumn("date", F.to_date("window_start")).hint("rebalance", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "static").partitionBy("date").parquet(f"{path}/data/{folder}")


def write_version(batch: DataFrame, batch_id: int, path: str, query: str | None = None) -> None:
    """Store one micro-batch's changed windows as a version of their own, by date of the window.

    A query keeps its run as long as its checkpoint; one with a new checkpoint counts batches from 0
    again and is a later run. A batch that is run again overwrites its own folder, and is left as it is once
    that has been merged. One small manifest is read and one written, however long the stream has run.
    """
    spark = batch.sparkSession
    query = query or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    manifest = read_manifest(spark, path)
    run = manifest["runs"].get(query, max(manifest["runs"].values(), default=-1) + 1)
    merged = max((f["batch"] for f in manifest["folders"] if f["level"] and f["run"] == run), default=-1)
    if batch_id <= merged:
        return
    new = {"path": _folder(0, run, batch_id), "level": 0, "run": run, "batch": batch_id}
    _store(batch, path, new["path"])
    folders = [f for f in manifest["folders"] if f != new] + [new]
    compact(spark, path, _commit(spark, path, manifest | {"runs": manifest["runs"] | {query: run}, "folders": folders}))


def latest_versions(versions: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """Newest version of every window: the later run first, inside a run the higher batch."""
    order = [F.desc(c) for c in ("run_id", "batch_id") if c in versions.columns]
    return latest(versions, keys, order)


def _read(spark: SparkSession, path: str, folders: Sequence[dict]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f['path']}" for f in folders])


def read_windows(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Newest version of every window; dates outside [since, until] are not read."""
    versions = _read(spark, path, read_manifest(spark, path)["folders"])
    if since:
        versions = versions.filter(F.col("date") >= F.lit(since).cast("date"))
    if until:
        versions = versions.filter(F.col("date") <= F.lit(until).cast("date"))
    return latest_versions(versions).drop("date", "level", "run_id", "batch_id")


def compact(spark: SparkSession, path: str, manifest: dict | None = None, merge: int | None = None) -> None:
    """Merge folders in place, `merge` of a level into one of the next, with a single version per window.

    Folders of a level follow each other, so the merged one counts as the newest of them. A row is
    rewritten once a level, and a store of n batches has fewer than merge x (1 + log n) folders.
    """
    manifest, merge, level = manifest or read_manifest(spark, path), merge or MERGE, 0
    while True:
        some = sorted((f for f in manifest["folders"] if f["level"] == level), key=lambda f: (f["run"], f["batch"]))
        if len(some) >= merge:
            top = some[-1]
            into = {"path": _folder(level + 1, top["run"], top["batch"]), "level": level + 1, "run": top["run"], "batch": top["batch"]}
            _store(latest_versions(_read(spark, path, some)).drop("date", "level", "run_id", "batch_id"), path, into["path"])
            manifest = _commit(spark, path, manifest | {
                "folders": [f for f in manifest["folders"] if f not in some] + [into],
                "retired": manifest["retired"] + [{"path": f["path"], "at": manifest["number"] + 1} for f in some]})
        elif all(f["level"] <= level for f in manifest["folders"]):
            return
        level += 1


def start(df: DataFrame, sink, checkpoint: str, mode: str = "update",
          every: str | None = "30 seconds") -> StreamingQuery:
    """Run a stream into a batch function; without an interval, all available data once.

    Errors in `sink` fail the query, so a batch is either stored or run again.
    """
    writer = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def upsert_windows(df: DataFrame, path: str, checkpoint: str,
                   every: str | None = "30 seconds") -> StreamingQuery:
    """Updated windows of every micro-batch into the versioned table at `path`."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                write_version(batch, batch_id, path)
        finally:
            batch.unpersist()

    return start(df, sink, checkpoint, "update", every)


def append_rows(df: DataFrame, path: str, checkpoint: str,
                every: str | None = "30 seconds") -> StreamingQuery:
    """Raw rows of a stream appended to Parquet, exactly once by the sink's own log."""
    writer = df.writeStream.format("parquet").outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def await_any(queries: Sequence[StreamingQuery], poll: float = 1.0) -> None:
    """Wait until one of the streams ends, stop the others, and raise its error if it had one."""
    try:
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(poll)
    finally:
        ended = [q for q in queries if not q.isActive]
        for q in queries:
            q.stop()
    for q in ended:
        if q.exception() is not None:
            raise q.exception()
