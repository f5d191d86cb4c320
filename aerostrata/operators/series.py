"""Row-based operators over long series: lags, rolling means, imputation, running maxima.

A single station may hold a large part of all rows, so no window here is partitioned by
the station alone.  A series is cut into time chunks; every chunk is given the last few
rows that precede it (its halo), which makes trailing windows inside the chunk exact.
What crosses chunks is one small row per chunk, bounded by the time span covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from aerostrata.functions.scalars import calendar_parts
from aerostrata.session import materialized

CHUNK, OWN = "_chunk", "_own"


def with_halo(df: DataFrame, key: str, order: Sequence[str], depth: int,
              chunk: str = "year") -> DataFrame:
    """Cut each series into chunks and prepend the `depth` rows before each chunk.

    `order` starts with the time column; further columns break ties.  Adds `_chunk` and
    `_own` (false on halo rows).  A chunk's tail is at most `depth` rows and a non-empty
    chunk has at least one, so the `depth` previous chunks always hold the whole halo.
    """
    tagged = df.withColumn(CHUNK, F.date_trunc(chunk, F.col(order[0])))
    newest_first = [F.desc(c) for c in order]
    tail = (
        tagged.withColumn("_rn", F.row_number().over(
            Window.partitionBy(key, CHUNK).orderBy(*newest_first)))
        .filter(F.col("_rn") <= depth).drop("_rn")
        .groupBy(key, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(
            *order, *[c for c in df.columns if c not in order and c != key]))).alias("_tail"))
    )
    before = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(-depth, -1)
    halo = tail.select(
        key, CHUNK,
        F.slice(F.reverse(F.flatten(F.collect_list("_tail").over(before))), 1, depth).alias("_h"),
    ).select(key, CHUNK, F.inline("_h"))
    return (
        tagged.withColumn(OWN, F.lit(True))
        .unionByName(halo.withColumn(OWN, F.lit(False)))
    )


def chunk_window(key: str, order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(key, CHUNK).orderBy(*order)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(OWN).drop(CHUNK, OWN)


def rolling_mean(column: str, rows: int, w: WindowSpec, digits: int | None = None) -> Column:
    """Mean of the last `rows` rows including this one, over whatever is not null.

    With `digits`, values are rounded to them and summed as whole numbers, so the result
    does not depend on the frame's sum order.
    """
    frame = w.rowsBetween(-(rows - 1), 0)
    if digits is None:
        return F.avg(column).over(frame)
    scale = 10.0 ** digits
    n = F.count(column).over(frame)
    return F.sum(F.rint(F.col(column) * scale)).over(frame) / scale / F.when(n > 0, n)


def lag_columns(lags: dict[str, Sequence[int]], w: WindowSpec) -> dict[str, Column]:
    return {f"{c}_lag_{k}": F.lag(c, k).over(w) for c, ks in lags.items() for k in ks}


def rolling_columns(rollings: Sequence[tuple[str, int]], w: WindowSpec,
                    digits: int | None = None) -> dict[str, Column]:
    return {f"{c}_roll_{n}": rolling_mean(c, n, w, digits) for c, n in rollings}


def lag_features(df: DataFrame, lags: dict[str, Sequence[int]], key: str = "station_id",
                 order: Sequence[str] = ("date",), chunk: str = "year") -> DataFrame:
    """Value `k` rows earlier in the same series, by row and not by calendar day."""
    depth = max(k for ks in lags.values() for k in ks)
    cut = with_halo(df, key, order, depth, chunk)
    return drop_halo(cut.withColumns(lag_columns(lags, chunk_window(key, order))))


def calendar_lags(df: DataFrame, lags: dict[str, Sequence[int]], key: str = "station_id",
                  date: str = "date") -> DataFrame:
    """Value exactly `k` days earlier, null where that day is missing.

    One shuffle on (key, day): each row writes its value to the days that look back at it.
    """
    offsets = sorted({k for ks in lags.values() for k in ks})
    shifted = df.select(
        key, date, *lags,
        F.explode(F.array(*[F.lit(k) for k in offsets])).alias("_k"),
    ).withColumn(date, F.date_add(date, F.col("_k")))
    wide = shifted.groupBy(key, date).agg(*[
        F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"{c}_lag_{k}")
        for c, ks in lags.items() for k in ks
    ])
    return df.join(wide, on=[key, date], how="left")


def rolling_features(df: DataFrame, rollings: Sequence[tuple[str, int]], key: str = "station_id",
                     order: Sequence[str] = ("date",), chunk: str = "year",
                     digits: int | None = None) -> DataFrame:
    depth = max(n for _, n in rollings) - 1
    cut = with_halo(df, key, order, depth, chunk)
    return drop_halo(cut.withColumns(rolling_columns(rollings, chunk_window(key, order), digits)))


# Band of ranks around the middle that is ranked exactly, and the accuracy of its two ends.
BAND, ACCURACY = (0.498, 0.502), 10_000


def group_medians(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Exact median per group and column, one row per group, without gathering a group.

    Mergeable sketches give two values that enclose the median within half a percent of the
    ranks.  What lies below is only counted, and equal values in between are reduced to counts
    before they are ranked; so outliers and heavy ties cost nothing.
    """
    group = [key, "_name"]
    long = df.select(key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("_name"), F.col(c).alias("_v")) for c in columns
    ]))).filter(F.col("_v").isNotNull())
    ends = long.groupBy(*group).agg(
        F.percentile_approx("_v", list(BAND), ACCURACY).alias("_ends"), F.count(F.lit(1)).alias("_total"))
    # One row per group for all that is below the band, one per value inside it.
    banded = long.join(ends, group).filter(F.col("_v") <= F.col("_ends")[1])
    counts = banded.groupBy(*group, F.when(F.col("_v") >= F.col("_ends")[0], F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_total").alias("_total"))
    up_to = Window.partitionBy(*group).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_to", F.sum("_n").over(up_to)).withColumn("_from", F.col("_to") - F.col("_n"))
    # Ranks of the two middle values, the same one twice for an odd count.
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") < rank) & (rank <= F.col("_to")), F.col("_v")))

    medians = ranked.groupBy(*group).agg(((at(low) + at(high)) / 2).alias("_median"))
    return medians.groupBy(key).agg(*[
        F.max(F.when(F.col("_name") == c, F.col("_median"))).alias(f"_median_{c}")
        for c in columns
    ])


def impute_columns(columns: Sequence[str], w: WindowSpec, rows: int = 7,
                   digits: int | None = None) -> dict[str, Column]:
    """Null to the trailing mean, then to the group's median (joined as `_median_<col>`)."""
    return {c: F.coalesce(F.col(c), rolling_mean(c, rows, w, digits), F.col(f"_median_{c}"))
            for c in columns}


def impute_rolling_median(df: DataFrame, columns: Sequence[str], key: str = "station_id",
                          order: Sequence[str] = ("date",), rows: int = 7, chunk: str = "year",
                          digits: int | None = None, medians: DataFrame | None = None) -> DataFrame:
    """Fill nulls from the trailing mean of the original values, else the group's median.

    `medians`, as `group_medians` returns them, stand in for the medians of `df` itself.
    """
    if medians is None:
        medians = group_medians(df, key, columns)
    cut = with_halo(df, key, order, rows - 1, chunk).join(medians, key, "left")
    filled = cut.withColumns(impute_columns(columns, chunk_window(key, order), rows, digits))
    return drop_halo(filled.drop(*[f"_median_{c}" for c in columns]))


def ranged(df: DataFrame, order: str, out: str = CHUNK) -> DataFrame:
    """The rows stored in ranges of `order`, numbered by `out`: equal values share a range, and
    ranges hold about as many rows each, whatever the values are."""
    return materialized(df.repartitionByRange(F.col(order)).withColumn(out, F.spark_partition_id()))


def ordinal_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rows (column, out): alphabetical 0-based code per distinct value, numbered range by range.

    Only one count per range meets in one place.
    """
    keys = ranged(df.select(column).distinct(), column)
    sizes = keys.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(CHUNK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy(CHUNK).orderBy(column))
    return keys.withColumn("_own", own).join(first, CHUNK).select(
        column, (F.col("_first") + F.col("_own") - 1).cast("int").alias(out))


def ordinal_encode(df: DataFrame, column: str = "station_id", out: str = "station_encoded",
                   codes: DataFrame | None = None) -> DataFrame:
    """Add the code of `column`, from `codes` if given; facts get it by a join that Spark
    broadcasts when the measured key list is small."""
    return df.join(codes if codes is not None else ordinal_codes(df, column, out), column, "left")


def calendar_features(df: DataFrame, time_col: str, hour: bool = False) -> DataFrame:
    return df.withColumns(calendar_parts(F.col(time_col), hour))


def prefix_max(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Highest value among all rows that come earlier in the order of one column.

    Ranges of the order column are scanned in parallel; one row per range carries the maximum
    of everything before it.
    """
    cut = ranged(df, order)
    tops = cut.groupBy(CHUNK).agg(F.max(value).alias("_top"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.select(CHUNK, F.max("_top").over(before).alias("_carry"))
    inside = Window.partitionBy(CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(carry, CHUNK)
        .withColumn(out, F.greatest(F.max(value).over(inside), F.col("_carry")))
        .drop(CHUNK, "_carry")
    )


def late_events(df: DataFrame, arrival: str, event_time: str, delay: str) -> DataFrame:
    """Mark rows older than the newest event seen before them minus the allowed delay."""
    seen = prefix_max(df, arrival, event_time, "_seen")
    mark = F.col("_seen") - F.expr(f"interval {delay}")
    return seen.withColumn("watermark", mark).withColumn(
        "is_late", F.coalesce(F.col(event_time) < F.col("watermark"), F.lit(False))).drop("_seen")
