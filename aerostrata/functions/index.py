"""Pollution index as column expressions: sub-index, composite, category, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.functions.scalars import computed_once, round_half_up
from aerostrata.schema import (
    BREAKPOINTS, CATEGORIES, CATEGORY_UPPER, INDEX_BREAKS, LABEL_MIDPOINTS, POLLUTANTS,
)


def sub_index(conc: Column, breakpoints: Sequence[float],
              scale: Sequence[float] = INDEX_BREAKS) -> Column:
    """Piecewise-linear map of a concentration onto the index scale.

    Bands are open below and closed above, null stays null, values at or under zero
    (and NaN) give 0 and values above the last breakpoint the top of the scale.
    """
    bands = F.when(conc.isNull(), F.lit(None).cast("double"))
    bands = bands.when(F.isnan(conc) | (conc <= 0), F.lit(0.0))
    for lo, hi, base, top in zip(breakpoints, breakpoints[1:], scale, scale[1:]):
        share = (conc - F.lit(float(lo))) / F.lit(float(hi - lo))
        bands = bands.when(conc <= float(hi), F.lit(float(base)) + F.lit(float(top - base)) * share)
    return bands.otherwise(F.lit(float(scale[-1])))


def sub_indices(columns: Sequence[str] = POLLUTANTS) -> dict[str, Column]:
    return {c: sub_index(F.col(c), BREAKPOINTS[c]) for c in columns}


def category(index: Column) -> Column:
    """Ordered category of an index value; null and NaN have none."""
    out = F.when(index.isNull() | F.isnan(index), F.lit(None).cast("string"))
    for upper, label in zip(CATEGORY_UPPER, CATEGORIES):
        out = out.when(index <= float(upper), F.lit(label))
    return out.otherwise(F.lit(CATEGORIES[-1]))


def severity(label: Column) -> Column:
    """Position of a category label in the severity order, 0 for the mildest."""
    out = F.when(label == CATEGORIES[0], F.lit(0))
    for i, name in enumerate(CATEGORIES[1:], start=1):
        out = out.when(label == name, F.lit(i))
    return out


def composite_index(df: DataFrame, columns: Sequence[str] = POLLUTANTS,
                    index: str = "ispu", label: str = "ispu_category") -> DataFrame:
    """Add the highest sub-index, rounded to one decimal, and the category of the unrounded one."""
    parts = list(sub_indices(columns).values())
    raw = F.greatest(*parts) if len(parts) > 1 else parts[0]
    return (
        computed_once(df, _raw_index=raw)
        .withColumns({index: round_half_up(F.col("_raw_index"), 1),
                      label: category(F.col("_raw_index"))})
        .drop("_raw_index")
    )


def dominant(columns: Sequence[str] = POLLUTANTS) -> Column:
    """Name of the pollutant with the highest sub-index; the later name wins a tie."""
    pairs = [
        F.when(v.isNotNull(), F.struct(v.alias("v"), F.lit(c).alias("name")))
        for c, v in sub_indices(columns).items()
    ]
    return F.array_max(F.array(*pairs))["name"]


def label_midpoint(label: Column) -> Column:
    """Mid-band index value of a category label, 0 for anything else."""
    out = F
    for name, value in LABEL_MIDPOINTS.items():
        out = out.when(label == name, F.lit(value))
    return out.otherwise(F.lit(0))


def decode_label(label: Column) -> Column:
    """Category name for an alphabetical class code; other text passes through."""
    codes = F.create_map(*[F.lit(x) for pair in enumerate(sorted(CATEGORIES)) for x in pair])
    # Only text that starts like a number is parsed; a failing parse costs an exception.
    numeric = F.when(label.rlike(r"^\s*[-+]?[.\d]"), label)
    code = numeric.try_cast("double").try_cast("int")
    return F.coalesce(F.try_element_at(codes, code), label)


def threshold_step(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the highest step whose inclusive lower bound the value reaches."""
    out = F
    for bound, name in sorted(steps[1:], key=lambda s: s[0], reverse=True):
        out = out.when((value >= float(bound)) & ~F.isnan(value), F.lit(name))
    return out.otherwise(F.lit(steps[0][1]))
