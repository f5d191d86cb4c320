"""Cleaning, validation and data-quality checks.

Every report is one aggregation over one scan: the counts of all rules sit side by
side in a single `agg`, are combined map-side and turned into long form afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions.scalars import parse_day
from aerostrata.schema import AUDIT_RULES, CLEANING_RULES, PAYLOAD_RULES, POLLUTANTS, RangeRule


def any_present(columns: Sequence[str] = POLLUTANTS) -> Column:
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()


def in_range(rule: RangeRule) -> Column:
    c = F.col(rule.column)
    return (c >= float(rule.low)) & (c <= float(rule.high))


def out_of_range(rule: RangeRule) -> Column:
    c = F.col(rule.column)
    return (c < float(rule.low)) | (c > float(rule.high))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def clean_ranges(df: DataFrame, rules: Sequence[RangeRule] = CLEANING_RULES) -> DataFrame:
    """Keep rows whose every ruled measure is present and inside its bounds."""
    return df.filter(_all([in_range(r) for r in rules]))


# Columns that may be null in a clean reading.
IDENTIFIERS = ["station_id", "station_name", "region", "tanggal", "date"]


def clean_readings(df: DataFrame, day: str = "tanggal") -> DataFrame:
    """The whole cleaning: some pollutant present, ranges, a day that parses, nothing else missing.

    The day is taken from the text column `day`, where there is one, as the column `date`.
    """
    kept = clean_ranges(df.filter(any_present()))
    if day in df.columns:
        kept = kept.withColumn("date", parse_day(F.col(day)))
    return drop_incomplete(kept.filter(F.col("date").isNotNull()), IDENTIFIERS)


def drop_incomplete(df: DataFrame, except_: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any column but the given identifiers."""
    return df.dropna(how="any", subset=[c for c in df.columns if c not in except_])


def _long(wide: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One wide row of counters, named `<name>__<field>`, as one row per name."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("check"),
                 *[F.col(f"{n}__{f}").alias(alias) for f, alias in fields.items()])
        for i, n in enumerate(names, start=1)
    ])
    return wide.select(F.inline(rows))


def cleaning_report(df: DataFrame, rules: Sequence[RangeRule] = CLEANING_RULES,
                    present: Sequence[str] = POLLUTANTS) -> DataFrame:
    """Rows entering and removed by each cleaning step in order, with a >50 % warning flag."""
    steps = [("any_present", any_present(present))]
    steps += [(r.column, F.coalesce(in_range(r), F.lit(False))) for r in rules]
    counters, passed = [], F.lit(True)
    for name, keep in steps:
        counters.append(F.count_if(passed).alias(f"{name}__in"))
        counters.append(F.count_if(passed & ~keep).alias(f"{name}__out"))
        passed = passed & keep
    wide = df.agg(*counters)
    out = _long(wide, [n for n, _ in steps], {"in": "rows_in", "out": "rows_removed"})
    return out.withColumn("over_half", F.col("rows_removed") > F.col("rows_in") * 0.5)


def payload_reasons(rules: Sequence[RangeRule] = PAYLOAD_RULES) -> Column:
    """Names of the measures outside their bounds; nulls are not a reason."""
    return F.array_compact(F.array(*[
        F.when(out_of_range(r), F.lit(r.column)) for r in rules
    ]))


def validate_rows(df: DataFrame, rules: Sequence[RangeRule] = PAYLOAD_RULES
                  ) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and rejected rows with their reasons.

    Rules for columns the frame does not have are skipped: an absent field is a null.
    """
    rules = [r for r in rules if r.column in df.columns]
    bad = _all([F.coalesce(~out_of_range(r), F.lit(True)) for r in rules])
    return df.filter(bad), df.filter(~bad).withColumn("reasons", payload_reasons(rules))


# --- expectation suite -------------------------------------------------------------

def expectations(df: DataFrame, not_null: Sequence[str] = (),
                 between: Sequence[RangeRule] = (), numeric_text: Sequence[str] = (),
                 types: dict[str, str] | None = None) -> DataFrame:
    """Evaluate an expectation suite in one pass, one row per expectation.

    Not-null and type checks count every row; a between check treats nulls as missing
    and reports the unexpected share of the present values and of all values.
    `types` compares declared column types, `numeric_text` counts text that is no number.
    """
    static = {f"type:{c}": df.schema[c].dataType.simpleString() == t
              for c, t in (types or {}).items()}
    aggs: list[Column] = []
    names: list[str] = []

    def add(name: str, missing: Column, unexpected: Column) -> None:
        names.append(name)
        aggs.extend([F.count(F.lit(1)).alias(f"{name}__n"),
                     missing.alias(f"{name}__missing"),
                     unexpected.alias(f"{name}__bad")])

    none = F.count_if(F.lit(False))
    for c in not_null:
        add(f"not_null:{c}", none, F.count_if(F.col(c).isNull()))
    for r in between:
        add(f"between:{r.column}", F.count_if(F.col(r.column).isNull()),
            F.count_if(out_of_range(r)))
    for c in numeric_text:
        add(f"numeric:{c}", F.count_if(F.col(c).isNull()),
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()))
    for name, ok in static.items():
        add(name, none, none if ok else F.count(F.lit(1)))
    long = _long(df.agg(*aggs), names, {"n": "element_count", "missing": "missing_count",
                                        "bad": "unexpected_count"}).drop("step")
    n, miss, bad = (F.col(c) for c in ("element_count", "missing_count", "unexpected_count"))
    return long.withColumns({
        "success": bad == 0,
        "unexpected_percent": F.when(n - miss > 0, bad * 100.0 / (n - miss)),
        "unexpected_percent_total": F.when(n > 0, bad * 100.0 / n),
    }).withColumnRenamed("check", "expectation")


def unexpected_values(df: DataFrame, rule: RangeRule, top: int = 20) -> DataFrame:
    """The most frequent values outside the bounds, as the suite's partial report shows them."""
    c = F.col(rule.column)
    return (
        df.filter(out_of_range(rule)).groupBy(c.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value")).limit(top)
    )


def suite_summary(results: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("success"))
    n = F.count(F.lit(1))
    return results.agg(
        n.alias("evaluated"), ok.alias("successful"), (n - ok).alias("unsuccessful"),
        (ok * 100.0 / F.when(n > 0, n)).alias("success_percent"),
    )


# --- table audit -------------------------------------------------------------------

def _profile(df: DataFrame, date_col: str, station_col: str = "station_id") -> list[Column]:
    n = F.count(F.lit(1))
    stations = F.count_distinct(station_col) if station_col in df.columns else F.max(F.lit(None).cast("long"))
    return [n.alias("row_count"), F.when(n > 0, F.count_if(F.col(date_col).isNull())).alias("null_dates"),
            stations.alias("distinct_stations")]


def profile_table(df: DataFrame, date_col: str, station_col: str = "station_id") -> DataFrame:
    """Row count, null dates, columns and distinct stations in one row."""
    return df.agg(*_profile(df, date_col, station_col)).withColumns(
        {"column_count": F.lit(len(df.columns)), "columns": F.lit(",".join(df.columns))})


def quality_run(tables: dict[str, tuple[DataFrame, str]], as_of: str, max_days: int = 2) -> DataFrame:
    """One row per table (name -> frame and its date column): profile, rows out of range, age. Each table is read once."""
    out = []
    for name, (df, day) in tables.items():
        bad = [F.count_if(out_of_range(r)) for r in _matched(df, AUDIT_RULES)[0]]
        one = df.agg(*_profile(df, day), reduce(lambda x, y: x + y, bad, F.lit(0).cast("long")).alias("out_of_range"),
                     F.max(F.to_date(day)).alias("latest"))
        out.append(one.select(F.lit(name).alias("table"), "row_count", "null_dates", "distinct_stations", F.lit(len(df.columns)).alias("column_count"),
                              "out_of_range", "latest", _stale(as_of, max_days).alias("stale")))
    return reduce(DataFrame.unionByName, out)


def _matched(df: DataFrame, rules: Sequence[RangeRule]) -> tuple[list[RangeRule], list[str]]:
    """The rules by the columns they find, and the names they had."""
    matched: list[RangeRule] = []
    labels: list[str] = []
    for r in rules:
        hit = next((c for c in df.columns if c == r.column or c.startswith(r.column + "_")
                    and c != f"{r.column}_category"), None)
        if hit:
            matched.append(RangeRule(hit, r.low, r.high))
            labels.append(r.column)
    return matched, labels


def audit_ranges(df: DataFrame, rules: Sequence[RangeRule] = AUDIT_RULES) -> DataFrame:
    """Non-null values outside each rule; a rule `x` also finds the first column `x_...`."""
    matched, labels = _matched(df, rules)
    wide = df.agg(*[F.count_if(out_of_range(r)).alias(f"{r.column}__bad") for r in matched])
    base = dict(zip([r.column for r in matched], labels))
    from_column = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    return (
        _long(wide, [r.column for r in matched], {"bad": "out_of_range"}).drop("step")
        .withColumns({"rule": from_column[F.col("check")], "passed": F.col("out_of_range") == 0})
        .withColumnRenamed("check", "column")
    )


def _stale(as_of: str, max_days: int) -> Column:
    return F.coalesce(F.date_diff(F.lit(as_of).cast("date"), F.col("latest")) > max_days, F.lit(True))


def freshness(df: DataFrame, date_col: str, as_of: str, max_days: int = 2) -> DataFrame:
    """Age in days of the newest date; an empty table has none and counts as stale."""
    newest = F.max(F.to_date(date_col))
    return df.agg(newest.alias("latest")).withColumn(
        "days_old", F.date_diff(F.lit(as_of).cast("date"), F.col("latest"))
    ).withColumn("stale", _stale(as_of, max_days))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.  The rank filter is also applied before the shuffle, so a key
    with very many copies sends at most one row per input task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First copy of each key seen by a stream, with state bounded by the watermark."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def retention(df: DataFrame, time_col: str, as_of: str, days: int = 90) -> DataFrame:
    """Rows not older than the retention period."""
    return df.filter(F.col(time_col) >= F.expr(f"date '{as_of}' - interval {days} days"))
