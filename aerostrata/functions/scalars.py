"""Scalar helpers: rounding, exact sums, parsing, calendar parts, formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions run exactly once per row.

    A filter on a projected column is pushed below the projection with the expression
    copied into it, once per mention.  For a large expression that outgrows what Spark can
    compile.  A one-element generator keeps it in one place; filters on other columns
    still reach the scan.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def round_half_up(value: Column, digits: int) -> Column:
    """Round half up on the double itself; stays in generated code, unlike `round`."""
    scale = 10.0 ** digits
    return F.floor(value * scale + 0.5) / scale


def total(value: Column, digits: int | None = None) -> Column:
    """Sum of the values as they are.  With `digits` they are first rounded to that many decimals
    and summed as whole numbers, which makes the last digits independent of the task order.

    Whole numbers are held in doubles: exact up to 2**53, ordinary double precision beyond,
    never an overflow error.
    """
    if digits is None:
        return F.sum(value)
    scale = 10.0 ** digits
    return F.sum(F.rint(value * scale)) / scale


def mean(value: Column, digits: int | None = None) -> Column:
    """Mean, over rounded values when `digits` is given; null when there is no non-null value."""
    if digits is None:
        return F.avg(value)
    n = F.count(value)
    return total(value, digits) / F.when(n > 0, n)


def parse_day(text: Column) -> Column:
    """First ten characters as a date; null when they are not one."""
    return F.substring(text, 1, 10).try_cast("date")


def parse_ts(text: Column) -> Column:
    """ISO text as a timestamp; null when it is not one."""
    return text.try_cast("timestamp")


def calendar_parts(ts: Column, hour: bool = False) -> dict[str, Column]:
    """Month or hour, weekday with Monday 0, weekend flag and day of month."""
    day = F.weekday(ts)
    first = {"hour_of_day": F.hour(ts)} if hour else {"month": F.month(ts)}
    return first | {
        "day_of_week": day,
        "is_weekend": (day >= 5).cast("int"),
        "day_of_month": F.dayofmonth(ts),
    }


def lookup(values: dict, key: Column, default: Column) -> Column:
    """Constant dictionary lookup with a default, as one map literal."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), default)


def percent_text(share: Column) -> Column:
    """A share as a whole percentage, such as 91%."""
    return F.concat(round_half_up(share * 100, 0).cast("int").cast("string"), F.lit("%"))


def params_text(text: Column) -> Column:
    """A printed parameter dictionary without braces and quotes, entries split by bars."""
    return F.replace(F.regexp_replace(text, r"[{}']", ""), F.lit(", "), F.lit(" | "))
