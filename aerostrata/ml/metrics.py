"""Classification metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.functions.scalars import round_half_up


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Count per (actual, predicted) pair in long form."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class_report(df: DataFrame, actual: str, predicted: str,
                     classes: Sequence[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, 0 where a ratio is undefined.

    The data is read once, into the confusion counts; the rest works on those.
    """
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted_n"), F.lit(0).cast("long").alias("hits")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted_n"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                 .otherwise(F.lit(0)).cast("long").alias("hits")),
    )
    counts = confusion_matrix(df, actual, predicted).select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted_n").alias("predicted_n"),
        F.sum("hits").alias("hits"))
    if classes:
        base = df.sparkSession.createDataFrame([(c,) for c in classes], "label string")
        counts = base.join(counts, "label", "full_outer").fillna(
            0, subset=["support", "predicted_n", "hits"])
    hits = F.col("hits").cast("double")
    precision = F.when(F.col("predicted_n") > 0, hits / F.col("predicted_n")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, hits / F.col("support")).otherwise(0.0)
    pr = F.col("precision") + F.col("recall")
    return (
        counts.withColumns({"precision": precision, "recall": recall})
        .withColumn("f1", F.when(pr > 0, 2 * F.col("precision") * F.col("recall") / pr).otherwise(0.0))
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class report plus a `weighted avg` row with accuracy, weighted by support."""
    report = per_class_report(df, actual, predicted)
    n = F.sum("support")

    def weighted(c: str):
        return F.sum(F.col(c) * F.col("support")) / n

    overall = report.agg(
        F.lit("weighted avg").alias("label"), n.alias("support"),
        (F.sum("hits").cast("double") / n).alias("accuracy"),
        weighted("precision").alias("precision"), weighted("recall").alias("recall"),
        weighted("f1").alias("f1"))
    out = report.withColumn("accuracy", F.lit(None).cast("double")).select(
        "label", "support", "accuracy", "precision", "recall", "f1").unionByName(overall)
    return out.withColumns({c: round_half_up(F.col(c), 6)
                            for c in ("accuracy", "precision", "recall", "f1")})
