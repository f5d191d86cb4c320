"""Tails of a window store: the last windows of every station after each micro-batch.

A tail is a folder of its own, named by run and batch; two are kept, the newest and the one it was made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostrata.streaming.windows import _fs


def tail_path(path: str, run: int, batch_id: int) -> str:
    return f"{path}/tail/run-{run}-batch-{batch_id}"


def _stored(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(run, batch) of the complete tails, oldest first."""
    fs, make = _fs(spark, path)
    folder = make(f"{path}/tail")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [n.split("-") for n in names if fs.exists(make(f"{path}/tail/{n}/_SUCCESS"))]
    return sorted((int(n[1]), int(n[3])) for n in done)


def earlier_tail(spark: SparkSession, path: str, run: int, batch_id: int) -> DataFrame | None:
    """The newest tail that is not the batch's own, which a batch that is run again must not read."""
    found = [t for t in _stored(spark, path) if t != (run, batch_id)]
    return spark.read.parquet(tail_path(path, *found[-1])) if found else None


def drop_tails(spark: SparkSession, path: str, run: int, batch_id: int) -> None:
    """Delete all but the tail of this batch and the one before it."""
    fs, make = _fs(spark, path)
    for r, b in [t for t in _stored(spark, path) if t != (run, batch_id)][:-1]:
        fs.delete(make(tail_path(path, r, b)), True)
