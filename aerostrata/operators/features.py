"""Model input: feature frames, temporal split, column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.scalars import mean
from aerostrata.operators.series import (
    calendar_features, chunk_window, drop_halo, group_medians, impute_columns,
    impute_rolling_median, lag_columns, ordinal_encode, rolling_columns, with_halo,
)
from aerostrata.schema import (
    DAILY_MEASURES, IMPUTE_ROWS, LAGS, NON_FEATURES, ROLLINGS, STREAM_MEASURES,
)


def batch_features(df: DataFrame, impute: bool = True, encode: bool = True,
                   chunk: str = "year", digits: int | None = None,
                   medians: DataFrame | None = None) -> DataFrame:
    """Daily features: imputed measures, lags, rolling means, calendar and station code.

    Imputation, lags and rolling means share one partitioning and order.  `medians` are those
    a model was trained with; without imputation the remaining nulls become 0.
    """
    key, order = "station_id", ["date"]
    lag_depth = max(k for ks in LAGS.values() for k in ks)
    depth = lag_depth + IMPUTE_ROWS - 1 if impute else lag_depth
    cut = with_halo(df, key, order, depth, chunk)
    w = chunk_window(key, order)
    if impute:
        cut = cut.join(medians if medians is not None else group_medians(df, key, DAILY_MEASURES), key, "left")
        cut = cut.withColumns(impute_columns(DAILY_MEASURES, w, IMPUTE_ROWS, digits))
        cut = cut.drop(*[f"_median_{c}" for c in DAILY_MEASURES])
    out = drop_halo(cut.withColumns(lag_columns(LAGS, w) | rolling_columns(ROLLINGS, w, digits)))
    if not impute:
        numeric = [f.name for f in out.schema if f.dataType.typeName() in ("double", "long", "integer")]
        out = out.fillna(0, subset=numeric)
    out = calendar_features(out, "date")
    return ordinal_encode(out, key) if encode else out


def stream_features(df: DataFrame, impute: bool = True, chunk: str = "day",
                    digits: int | None = None, medians: DataFrame | None = None) -> DataFrame:
    """Windowed features: imputed measures and calendar parts with the hour.

    Nulls take the trailing mean over the station's windows, then its median: of `medians`, those a
    model was trained with, or of the windows given. A micro-batch brings the windows before it along.
    """
    if impute or medians is not None:
        df = impute_rolling_median(df, STREAM_MEASURES, order=["window_start"], rows=IMPUTE_ROWS,
                                   chunk=chunk, digits=digits, medians=medians)
    else:
        df = df.fillna(0, subset=STREAM_MEASURES)
    return calendar_features(df, "window_start", hour=True)


def feature_columns(df: DataFrame, exclude: set[str] = NON_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def temporal_split(df: DataFrame, test_days: int = 7, label: str = "aqi_category",
                   date: str = "date") -> DataFrame:
    """Mark rows train or test by the last `test_days` days, complete labelled rows only.

    The cut-off is taken over every labelled row, before incomplete ones are dropped.
    """
    labelled = df.filter(F.col(label).isNotNull())
    newest = labelled.agg(F.max(F.to_date(date))).scalar()
    cutoff = F.date_sub(newest, test_days)
    complete = labelled.dropna(subset=feature_columns(labelled))
    return complete.withColumn(
        "split", F.when(F.to_date(date) <= cutoff, F.lit("train")).otherwise(F.lit("test")))


def with_horizon(df: DataFrame, days: int, label: str = "aqi_category",
                 key: str = "station_id", date: str = "date") -> DataFrame:
    """Replace the label by the one `days` days later, so features cannot contain it."""
    future = df.select(key, F.date_sub(date, days).alias(date), F.col(label).alias("_future"))
    return df.drop(label).join(future, [key, date], "inner").withColumnRenamed("_future", label)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Class weights n / (classes x class count), from the class counts alone."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(every).cast("double")
                             / (F.count(F.lit(1)).over(every) * F.col("n")))


def with_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    weights = balanced_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(weights, label)


def has_rows(df: DataFrame, minimum: int) -> bool:
    """Whether there are at least `minimum` rows; stops reading once they are found."""
    return df.limit(minimum).count() >= minimum


def station_means(df: DataFrame, measures: Sequence[str], key: str = "station_id",
                  digits: int | None = None) -> DataFrame:
    return df.groupBy(key).agg(*[mean(F.col(c), digits).alias(c) for c in measures]).dropna(
        subset=list(measures))
