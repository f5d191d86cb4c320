"""Progress of streams as audit rows: counted rows, quarantined rows, late rows and batch times."""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from aerostrata.operators.quality import out_of_range, validate_rows
from aerostrata.schema import PAYLOAD_RULES, RangeRule
from aerostrata.streaming.windows import _fs

PROGRESS = ("query_id string, run_id string, name string, batch_id long, at timestamp, input_rows long, rows_in long, "
            "quarantined long, late long, batch_ms long")
QUALITY = "quality"


def observed_valid(df: DataFrame, rules: Sequence[RangeRule] = PAYLOAD_RULES) -> DataFrame:
    """Valid rows of a stream; all rows and the quarantined ones are counted on the way, in the same pass."""
    bad = reduce(or_, [F.coalesce(out_of_range(r), F.lit(False)) for r in rules if r.column in df.columns], F.lit(False))
    return validate_rows(df.observe(QUALITY, F.count(F.lit(1)).alias("rows_in"), F.count_if(bad).alias("quarantined")), rules)[0]


class ProgressLog(StreamingQueryListener):
    """Stores a row for each micro-batch of every stream of the session, `every` rows a file and the rest when a stream ends.

    A file is named by run and last batch. Rows not yet stored are lost with the driver; the streams' own results are not.
    late counts rows that state operators dropped, after their partial aggregation. Close it to stop listening.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self._rows: dict[str, list[dict]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def _flush(self, run: str) -> None:
        rows = self._rows.pop(run, [])
        if rows:
            fs, make = _fs(self.spark, self.path)
            out = fs.create(make(f"{self.path}/{run}-{rows[-1]['batch_id']:012d}.json"), True)
            out.write("\n".join(map(json.dumps, rows)).encode())
            out.close()

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(QUALITY)
        run = str(p.runId)
        self._rows.setdefault(run, []).append({
            "query_id": str(p.id), "run_id": run, "name": p.name, "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows,
            "rows_in": seen["rows_in"] if seen else None, "quarantined": seen["quarantined"] if seen else None,
            "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators), "batch_ms": p.batchDuration})
        if len(self._rows[run]) >= self.every:
            self._flush(run)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        try:
            self._flush(str(event.runId))
        finally:
            self._end(str(event.runId)).set()

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until the rows of an ended run are stored; events arrive a little after a stream's end."""
        if not self._end(str(run_id)).wait(seconds):
            raise TimeoutError(f"no end of run {run_id} was reported")

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Stored progress, one row for each run and batch."""
    return spark.read.schema(PROGRESS).json(path).dropDuplicates(["run_id", "batch_id"])
