"""Scoring of windowed micro-batches on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostrata.ml.models import StoredModel, newest_model, read_model, score
from aerostrata.operators.features import stream_features
from aerostrata.schema import IMPUTE_ROWS
from aerostrata.streaming.tails import drop_tails, earlier_tail, tail_path
from aerostrata.streaming.windows import WINDOW_KEYS, newest_stored, read_windows, start, write_version

SCORED = ["station_id", "window_start", "window_end", "pm25_avg", "pm10_avg", "ispu_avg"]


# Windows kept of every station: six that a trailing mean looks back on, and those that late readings may still change.
LOOK_BACK, TAIL = IMPUTE_ROWS - 1, 24


def score_windows(windows: DataFrame, model: StoredModel) -> DataFrame:
    """Windowed rows with prediction, through the features and medians the model was trained on."""
    features = stream_features(windows, impute=model.medians is not None, medians=model.medians)
    return score(features, model).select(*SCORED, "predicted_label", "confidence")


def with_tail(batch: DataFrame, tail: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The batch's windows after the station's last stored ones, and the tail to store next.

    Rows get `_again`: true for windows of the batch and for the LOOK_BACK stored ones after the first of
    them, whose trailing means they may change. Ranks are taken per station over a batch and a tail.
    """
    marked = batch.withColumn("_new", F.lit(True))
    if tail is not None:
        kept = tail.join(batch.select(*WINDOW_KEYS), list(WINDOW_KEYS), "left_anti")
        marked = marked.unionByName(kept.select(*batch.columns).withColumn("_new", F.lit(False)))
    by_time = Window.partitionBy("station_id").orderBy("window_start")
    before = F.coalesce(F.bool_or("_new").over(by_time.rowsBetween(-LOOK_BACK, 0)), F.lit(False))
    renewed = (marked.select("*", F.row_number().over(Window.partitionBy("station_id").orderBy(F.desc("window_start"))).alias("_rank"))
               .filter(F.col("_rank") <= TAIL).select(*batch.columns))
    return marked.withColumn("_again", before).drop("_new"), renewed


def score_batch(batch: DataFrame, tail: DataFrame | None, model: StoredModel) -> DataFrame:
    """Predictions of the batch's windows, and again of stored ones that it may have changed."""
    rows, _ = with_tail(batch, tail)
    again = rows.filter("_again").select(*WINDOW_KEYS)
    return score_windows(rows.drop("_again"), model).join(again, list(WINDOW_KEYS), "left_semi")


def score_stream(df: DataFrame, windows_path: str, scores_path: str, models: str, checkpoint: str,
                 every: str | None = "30 seconds") -> StreamingQuery:
    """Store updated windows and, once a model is available, their predictions.

    The manifest is looked at with every micro-batch, so a newer model takes over at once.  The
    first batch that finds a model also scores the windows stored before there was one. Nulls take the
    trailing mean over the station's last windows, as in batch: these are stored beside the windows
    as a tail that every batch reads and renews. A batch that is run again reads the tail it read before.
    """
    held: dict[str, StoredModel] = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            if batch.isEmpty():
                return
            found = newest_model(spark, models)
            backlog = found is not None and newest_stored(spark, scores_path) is None
            write_version(batch, batch_id, windows_path)
            run = newest_stored(spark, windows_path)[0]
            before = earlier_tail(spark, windows_path, run, batch_id)
            with_tail(batch, before)[1].coalesce(1).write.mode("overwrite").parquet(tail_path(windows_path, run, batch_id))
            drop_tails(spark, windows_path, run, batch_id)
            if found is None:
                return
            if found[0] not in held:
                held.clear()
                held[found[0]] = read_model(spark, found[1], found[0])
            model = held[found[0]]
            scored = score_windows(read_windows(spark, windows_path).select(*batch.columns), model) if backlog else score_batch(batch, before, model)
            write_version(scored.withColumns({"model_version": F.lit(found[0]), "created_at": F.current_timestamp()}), batch_id, scores_path)
        finally:
            batch.unpersist()

    return start(df, sink, checkpoint, "update", every)
