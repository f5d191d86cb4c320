"""Daily, windowed and serving aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.index import category
from aerostrata.functions.scalars import mean, round_half_up, total
from aerostrata.schema import AVERAGED


def _measures(df: DataFrame, index_name: str, digits: int | None) -> list[Column]:
    out = []
    for c in AVERAGED:
        name = index_name if c == "ispu" else f"{c}_avg"
        out.append(round_half_up(mean(F.col(c), digits), 2).alias(name))
    if "uv_index" in df.columns:
        out.append(round_half_up(mean(F.col("uv_index"), digits), 2).alias("uv_index_avg"))
    out.append(round_half_up(total(F.col("precipitation"), digits), 2).alias("precipitation_sum"))
    out.append(F.count(F.lit(1)).alias("record_count"))
    return out


def daily_agg(df: DataFrame, keys: Sequence[str] = ("station_id", "date"),
              digits: int | None = None) -> DataFrame:
    """Rounded daily means per station, with the category of the rounded mean index.

    `digits` here and below: see `functions.scalars.total`.
    """
    out = df.groupBy(*keys).agg(*_measures(df, "ispu", digits))
    return out.withColumn("aqi_category", category(F.col("ispu")))


def window_agg(df: DataFrame, time_col: str = "ts", window: str = "10 minutes",
               slide: str | None = "5 minutes", key: str = "station_id",
               digits: int | None = None) -> DataFrame:
    """Rounded means per station and event-time window; no slide makes it tumbling.

    In a batch a window that is a multiple of its slide is built from tumbling panes of
    the slide length, so each row is aggregated once instead of once per window.
    """
    if slide and not df.isStreaming and not pd.Timedelta(window) % pd.Timedelta(slide):
        return _paned(df, time_col, window, slide, key, digits)
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    return df.groupBy(key, w.alias("w")).agg(*_measures(df, "ispu_avg", digits)).select(
        key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[c for c in _measure_names(df)])


def _measure_names(df: DataFrame) -> list[str]:
    names = ["ispu_avg" if c == "ispu" else f"{c}_avg" for c in AVERAGED]
    return names + (["uv_index_avg"] if "uv_index" in df.columns else []) + [
        "precipitation_sum", "record_count"]


def _paned(df: DataFrame, time_col: str, window: str, slide: str, key: str,
           digits: int | None) -> DataFrame:
    measures = AVERAGED + (["uv_index"] if "uv_index" in df.columns else [])
    scale = 1.0 if digits is None else 10.0 ** digits

    def whole(c: str) -> Column:
        return F.col(c) if digits is None else F.rint(F.col(c) * scale)

    partial = [F.sum(whole(c)).alias(f"s_{c}") for c in measures]
    partial += [F.count(c).alias(f"n_{c}") for c in measures]
    partial += [F.sum(whole("precipitation")).alias("s_precipitation"),
                F.count(F.lit(1)).alias("n")]
    panes = df.groupBy(key, F.window(time_col, slide).alias("p")).agg(*partial)
    w = F.window(F.col("p.start"), window, slide)
    final = []
    for c in measures:
        n = F.sum(f"n_{c}")
        average = F.sum(f"s_{c}") / scale / F.when(n > 0, n)
        final.append(round_half_up(average, 2).alias("ispu_avg" if c == "ispu" else f"{c}_avg"))
    final.append(round_half_up(F.sum("s_precipitation") / scale, 2).alias("precipitation_sum"))
    final.append(F.sum("n").alias("record_count"))
    return panes.groupBy(key, w.alias("w")).agg(*final).select(
        key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *_measure_names(df))


# --- serving views -----------------------------------------------------------------

def since(df: DataFrame, time_col: str, as_of: str, interval: str,
          until: str = "0 seconds") -> DataFrame:
    """Look-back filter: from `interval` before the instant to `until` after it, both included.

    Both ends are literals, so the filter reaches the scan of a stored column.  For readings
    that feed windows, `until` is the window's length and the filter goes below the windowing.
    """
    typ = df.schema[time_col].dataType.typeName()
    ends = [F.expr(f"CAST(timestamp_ntz '{as_of}' {part} AS {typ})")
            for part in (f"- interval {interval}", f"+ interval {until}")]
    return df.filter((F.col(time_col) >= ends[0]) & (F.col(time_col) <= ends[1]))


def lookback(df: DataFrame, date_col: str, as_of: str, days: int) -> DataFrame:
    """Dates from `days` before the given day onwards, both ends included."""
    return df.filter(F.col(date_col) >= F.expr(f"date '{as_of}' - interval {days} days")) \
             .filter(F.col(date_col) <= F.expr(f"date '{as_of}'"))


def mean_value(df: DataFrame, column: str, places: int = 1, digits: int | None = None) -> DataFrame:
    return df.agg(round_half_up(mean(F.col(column), digits), places).alias("value"))


def worst(df: DataFrame, column: str, keys: Sequence[str], n: int = 1) -> DataFrame:
    """The n rows with the highest value; nulls last, ties by the key columns."""
    return df.orderBy(F.desc_nulls_last(column), *[F.asc(k) for k in keys]).limit(n)


def distinct_above(df: DataFrame, key: str, column: str, threshold: float) -> DataFrame:
    high = (F.col(column) > threshold) & ~F.isnan(column)
    return df.filter(high).agg(F.count_distinct(key).alias("value"))


def distinct_bitmaps(df: DataFrame, number: Column, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the whole numbers that occur: keys, bucket, bits. Stored per day, they answer any look-back.

    A bitmap covers 32,768 numbers next to each other; nulls are left out. Keys may not be named bucket or bits.
    """
    rows = df.select(*keys, number.cast("bigint").alias("bits")).filter("bits IS NOT NULL")
    bucket = F.bitmap_bucket_number("bits").alias("bucket")
    return rows.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bits")).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of fewer keys, or of several stored parts."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How many different numbers the bitmaps of a key hold together, exactly."""
    merged = merge_bitmaps(bitmaps, keys)
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("value"))


def coverage_pct(df: DataFrame, time_col: str, hours: int = 24,
                 by: Sequence[str] = ()) -> DataFrame:
    """Share of the hours in which anything was recorded, as a whole percentage."""
    seen = F.count_distinct(F.date_trunc("hour", time_col))
    return df.groupBy(*by).agg(round_half_up(seen / float(hours) * 100, 0).alias("value"))


def category_distribution(df: DataFrame, date_col: str = "date",
                          label: str = "aqi_category") -> DataFrame:
    return df.groupBy(date_col, label).agg(F.count(F.lit(1)).alias("n"))


def category_share(df: DataFrame, label: str = "aqi_category") -> DataFrame:
    """Share of each category; the total is taken over the few category counts."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", round_half_up(F.col("n") * 100.0 / total, 2))


def long_series(df: DataFrame, time_col: str, series: dict[str, str],
                key: str = "station_id") -> DataFrame:
    """Measures as one row per series, `<station> <suffix>`, in one scan."""
    rows = F.array(*[F.struct(F.concat(F.col(key), F.lit(f" {s}")).alias("metric"),
                              F.col(c).alias("value")) for c, s in series.items()])
    return df.select(F.col(time_col).alias("time"), F.inline(rows))


def series_reducers(df: DataFrame, column: str, order: Column,
                    key: str = "station_id", digits: int | None = None) -> DataFrame:
    """Mean, extremes, last and last non-null value per series."""
    v = F.col(column)
    return df.groupBy(key).agg(
        round_half_up(mean(v, digits), 4).alias("mean"),
        F.max(v).alias("max"), F.min(v).alias("min"),
        F.max_by(v, order).alias("last"),
        F.max_by(v, F.when(v.isNotNull(), order)).alias("last_not_null"),
    )


def heatmap_hour_day(df: DataFrame, time_col: str, column: str,
                     digits: int | None = None) -> DataFrame:
    return df.groupBy(F.to_date(time_col).alias("day"), F.hour(time_col).alias("hour")).agg(
        round_half_up(mean(F.col(column), digits), 2).alias("mean_value"),
        F.count(F.lit(1)).alias("n"))


def heatmap_histogram(df: DataFrame, time_col: str, column: str, width: float = 10) -> DataFrame:
    """Counts per hour and fixed-width value bucket."""
    bucket = (F.floor(F.col(column) / float(width)) * float(width)).cast("double")
    return df.filter(F.col(column).isNotNull()).groupBy(
        F.date_trunc("hour", time_col).alias("hour"), bucket.alias("bucket"),
    ).agg(F.count(F.lit(1)).alias("n"))


def newest(df: DataFrame, columns: Sequence[str], order: Sequence[Column], n: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(n).select(*columns)


def table_summary(df: DataFrame, time_col: str) -> DataFrame:
    return df.agg(F.min(time_col).alias("first"), F.max(time_col).alias("last"),
                  F.count(F.lit(1)).alias("n"))


# --- analyses ----------------------------------------------------------------------

def weekend_ttest(df: DataFrame, date_col: str, column: str, by: Sequence[str] = (),
                  digits: int | None = None) -> DataFrame:
    """Weekend against weekday means with Welch's t statistic and degrees of freedom."""
    v, weekend = F.col(column), F.weekday(date_col) >= 5
    aggs = []
    for name, cond in (("weekend", weekend), ("weekday", ~weekend)):
        x = F.when(cond, v)
        aggs += [F.count(x).alias(f"{name}_n"), mean(x, digits).alias(f"{name}_mean"),
                 F.var_samp(x).alias(f"{name}_var")]
    a, b = (F.col(f"{n}_var") / F.col(f"{n}_n") for n in ("weekend", "weekday"))
    n1, n2 = F.col("weekend_n"), F.col("weekday_n")
    diff = F.col("weekend_mean") - F.col("weekday_mean")
    dof = (a + b) * (a + b) / (a * a / F.when(n1 > 1, n1 - 1) + b * b / F.when(n2 > 1, n2 - 1))
    return df.groupBy(*by).agg(*aggs).select(
        *by, "weekend_n", "weekday_n",
        round_half_up(F.col("weekend_mean"), 4).alias("weekend_mean"),
        round_half_up(F.col("weekday_mean"), 4).alias("weekday_mean"),
        round_half_up(diff / F.sqrt(F.when(a + b > 0, a + b)), 4).alias("t"),
        round_half_up(dof, 2).alias("dof"),
    )


def correlations(df: DataFrame, column: str, others: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of one measure with several others, one row each."""
    wide = df.groupBy(*by).agg(*[F.corr(column, o).alias(o) for o in others])
    rows = F.array(*[F.struct(F.lit(o).alias("measure"),
                              round_half_up(F.col(o), 4).alias("corr")) for o in others])
    return wide.select(*by, F.inline(rows))


def idw_grid(points: DataFrame, value: str, cell: float, radius: int,
             x: str = "longitude", y: str = "latitude", digits: int | None = None) -> DataFrame:
    """Inverse-distance interpolation between stations on a regular grid.

    Each station writes its weight into the cells within `radius` of its own, then the
    cells are aggregated; the work is stations x cells in reach, with no join.
    """
    off = F.sequence(F.lit(-radius), F.lit(radius))
    gx, gy = (F.floor(F.col(c) / cell) for c in (x, y))
    spread = (
        points.filter(F.col(value).isNotNull())
        .select(x, y, value, F.explode(off).alias("dx"))
        .select("*", F.explode(off).alias("dy"))
        .select(x, y, value, (gx + F.col("dx")).alias("cell_x"), (gy + F.col("dy")).alias("cell_y"))
    )
    dx = (F.col("cell_x") + 0.5) * cell - F.col(x)
    dy = (F.col("cell_y") + 0.5) * cell - F.col(y)
    d2 = dx * dx + dy * dy
    # A station on a cell centre outweighs the rest instead of dividing by zero.
    w = 1.0 / F.greatest(d2, F.lit(1e-9))
    return spread.withColumn("w", w).groupBy("cell_x", "cell_y").agg(
        round_half_up(total(F.col("w") * F.col(value), digits) / total(F.col("w"), digits), 2)
        .alias("value"),
        F.count(F.lit(1)).alias("stations"),
    )
