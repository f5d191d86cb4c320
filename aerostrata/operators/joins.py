"""Joins of feeds, dimensions and stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.operators.quality import dedup


def merge_feeds(air: DataFrame, weather: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer merge of two snapshots, one row per key on each side.

    A key seen by one feed only keeps the other feed's fields null; rows in which
    neither feed delivered anything do not occur.
    """
    return air.join(weather, on=list(on), how="full_outer")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
           ties: bool = False) -> DataFrame:
    """Newest row per key; with `ties` every row that shares the newest position.

    `order` must be descending.  Both ranks are group limits for Spark, which prunes
    each input task to its own leaders before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn("_rank", rank.over(w)).filter("_rank = 1").drop("_rank")


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the globally highest value, found by a scalar subquery."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def with_dimension(facts: DataFrame, dim: DataFrame, on: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join with a dimension.  No hint: Spark broadcasts the dimension when its
    measured size is below the session's limit and splits skewed keys otherwise."""
    return facts.join(dim, on=list(on), how=how)


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: Sequence[str],
                     order: Sequence[Column]) -> DataFrame:
    """Rows of `new` to append: the first per key, and only keys not stored yet."""
    return dedup(new, keys, order).join(
        existing.select(*keys), on=list(keys), how="left_anti")
