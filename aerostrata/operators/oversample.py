"""Oversampling of rare classes between nearest neighbours.

Neighbours are searched inside a class only. Each of `tables` searches cuts the class into cells along random
directions, at quantiles that make a cell hold about `block` vectors at any size of the class; cells that still
hold more are cut again along a further direction. Vectors are compared inside a cell, the best `k` of all
searches count. So the work grows with rows x tables x block, and no group holds more than a few blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.session import materialized

K, TABLES, BLOCK, DIRECTIONS, FINE = 5, 8, 256, 4, 256
# Rows made per step of a source, and sources numbered together.
CHUNK, NUMBERED = 10_000, 1_000
# Rows of a cell compared with the whole cell at once.
STRIPE = 256
LEVELS = [i / FINE for i in range(1, FINE)]


def _borders(cuts, parts):
    """The parts - 1 of the FINE - 1 quantiles that split into `parts` equal ones."""
    return F.when(parts > 1, F.transform(F.sequence(F.lit(1), F.greatest(parts, F.lit(2)).cast("int") - 1),
                                         lambda i: F.get(cuts, F.floor(i * FINE / parts).cast("int") - 1))).otherwise(F.array())


def _part(value, borders):
    return F.size(F.filter(borders, lambda x: x < value))


def nearest_in_class(points: DataFrame, size: int, k: int = K, tables: int = TABLES, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """Rows (c, id, v) with distinct ids to (c, id, v, near): up to k others of class c, as (d, id, v) by distance, then id.

    `size` is the length of the vectors v, which hold finite numbers. Approximate: a neighbour counts if it shares a cell
    with the row in one of the searches.
    """
    names = ["c", "id", "v"]
    way = np.random.default_rng(seed).normal(size=(tables, DIRECTIONS + 1, size))
    along = [[sum((F.col("v")[i] * float(w) for i, w in enumerate(x)), F.lit(0.0)) for x in t] for t in way]
    placed = points.select(*names, F.posexplode(F.array(*[F.array(*t) for t in along])).alias("t", "p"))
    cuts = placed.groupBy("c", "t").agg(F.count("*").alias("n"), *[F.percentile_approx(F.col("p")[j], LEVELS, 1_000).alias(f"q{j}") for j in range(DIRECTIONS)])
    parts = F.least(F.lit(FINE), F.ceil(F.pow(F.col("n") / block, 1 / DIRECTIONS)))
    cuts = materialized(cuts.select("c", "t", *[_borders(F.col(f"q{j}"), parts).alias(f"b{j}") for j in range(DIRECTIONS)]))
    cell = F.array(*[_part(F.col("p")[j], F.col(f"b{j}")) for j in range(DIRECTIONS)])
    placed = materialized(placed.join(cuts, ["c", "t"]).select(*names, "t", cell.alias("cell"), F.col("p")[DIRECTIONS].alias("further")))
    place = ["c", "t", "cell"]
    full = materialized(placed.groupBy(*place).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * block))
    cut = placed.join(full, place).groupBy(*place).agg(F.first("n").alias("n"), F.percentile_approx("further", LEVELS, 1_000).alias("q"))
    cut = materialized(cut.select(*place, "n", _borders(F.col("q"), F.least(F.lit(FINE), F.ceil(F.col("n") / block))).alias("borders")))
    placed = placed.join(cut, place, "left")
    sub = F.when(F.col("n").isNotNull(), _part(F.col("further"), F.col("borders")))
    # What even the finest cuts leave together is dealt out by hash.
    salt = F.when(F.col("n").isNotNull(), F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / (block * FINE)).cast("bigint")))
    placed = placed.select(*names, "t", "cell", F.coalesce(sub, F.lit(0)).alias("sub"), F.coalesce(salt, F.lit(0)).alias("salt"))

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("id")
        ids, n = rows.column("id").to_numpy(), rows.num_rows
        v = pc.list_flatten(rows.column("v")).to_numpy().reshape(n, size)
        most = min(k, n - 1)
        near, far = [np.zeros(0, np.int64)], [np.zeros(0)]
        for at in range(0, n, STRIPE):
            part = v[at:at + STRIPE]
            d = np.sqrt(sum((part[:, i, None] - v[:, i]) ** 2 for i in range(size)))
            d[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
            # Of those as near as the last one that counts the smallest ids stay: columns are in their order.
            last = np.partition(d, most - 1, axis=1)[:, most - 1:most] if most else np.zeros((len(part), 1))
            r, j = np.nonzero((d <= last) if most else np.zeros(d.shape, bool))
            order = np.lexsort((j, d[r, j], r))
            r, j = r[order], j[order]
            first = np.arange(len(r)) - np.searchsorted(r, r) < most
            near.append(j[first]), far.append(d[r[first], j[first]])
        j, d = np.concatenate(near), np.concatenate(far)
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(j) + 1) * size, pa.int32()), pa.array(v[j].ravel()))
        found = pa.StructArray.from_arrays([pa.array(d), pa.array(ids[j]), vectors], names=["d", "id", "v"])
        found = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * most, pa.int32()), found)
        return pa.table([rows.column("c"), rows.column("id"), rows.column("v"), found], names=["c", "id", "v", "near"])

    kind = placed.schema["c"].dataType.simpleString()
    found = placed.groupBy(*place, "sub", "salt").applyInArrow(
        compare, f"c {kind}, id long, v array<double>, near array<struct<d: double, id: long, v: array<double>>>")
    # A row has k x tables candidates at most.
    return found.groupBy("c", "id").agg(F.first("v").alias("v"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k).alias("near"))


def oversample(df: DataFrame, label: str, features: Sequence[str], k: int = K, tables: int = TABLES, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """All rows, and new ones until each class counts as many as the largest.

    A new row has its class, features between those of a row and of one of its k nearest others of the class, and nulls
    elsewhere; columns synthetic, origin and partner (feature arrays, null for given rows) come last and replace such columns.
    Every distinct vector of a class is an origin, all equally often but for one. Equal vectors count as one; a class with a single
    one gets copies of it. Rows with a null or non-finite feature count in their class but are no origin; a class without origins
    stays as it is, and so do rows without a label. The draws depend on the vectors and `seed` alone. An empty table stays empty.
    """
    given = df.drop("synthetic", "origin", "partner")
    kinds = {f.name: f.dataType for f in given.schema}
    vector = F.array(*[F.col(f).cast("double") for f in features])
    flat = given.filter(F.col(label).isNotNull()).select(F.col(label).alias("c"), vector.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    counts = flat.groupBy("c").agg(F.count("*").alias("n"))
    # One row for each class from here on; minus zero equals zero.
    counts = materialized(counts)
    need = counts.select("c", (counts.agg(F.max("n")).scalar() - F.col("n")).alias("need")).filter("need > 0")
    plain = flat.filter(finite).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).distinct()
    points = materialized(plain.join(need, "c").withColumn("h", F.xxhash64("v")))

    # Numbers inside a class, from the counts of buckets of about NUMBERED vectors.
    some = points.groupBy("c").agg(F.count("*").alias("origins"))
    bucketed = points.join(some, "c").withColumn("b", F.pmod("h", F.ceil(F.col("origins") / NUMBERED).cast("bigint")))
    sums = bucketed.groupBy("c", "b").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy("c").orderBy("b")) - F.col("m")
    order = F.row_number().over(Window.partitionBy("c", "b").orderBy("h", "v")) - 1
    numbered = materialized(bucketed.withColumn("at", order).join(sums.select("c", "b", before.alias("before")), ["c", "b"])
                            .withColumn("id", (F.col("before") + F.col("at")).cast("bigint"))
                            .withColumn("copies", F.floor(F.col("need") / F.col("origins")) + (F.col("id") < F.col("need") % F.col("origins")).cast("bigint")))
    near = nearest_in_class(numbered.select("c", "id", "v"), len(features), k, tables, block, seed)
    made = near.join(numbered.filter("copies > 0").select("c", "id", "h", "copies"), ["c", "id"])
    made = made.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / CHUNK)))).hint("rebalance")
    first = F.col("part") * CHUNK
    made = made.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("copies"), first + CHUNK) - 1)))

    def draw(what):
        return F.pmod(F.xxhash64("h", "copy", F.lit(seed), F.lit(what)), F.lit(1 << 30))

    other = F.when(F.size("near") > 0, F.expr("near")[F.pmod(draw("partner"), F.greatest(F.size("near"), F.lit(1))).cast("int")]["v"]).otherwise(F.col("v"))
    made = made.select("c", "v", other.alias("p"), (draw("share") / (1 << 30)).alias("u"))
    values = {f: F.col("v")[i] + F.col("u") * (F.col("p")[i] - F.col("v")[i]) for i, f in enumerate(features)}
    new = made.select(*[values[c].alias(c) if c in values else F.col("c").alias(c) if c == label else F.lit(None).cast(kinds[c]).alias(c) for c in given.columns],
                      F.lit(True).alias("synthetic"), F.col("v").alias("origin"), F.col("p").alias("partner"))
    old = given.select(*[F.col(c).cast("double").alias(c) if c in values else F.col(c) for c in given.columns], F.lit(False).alias("synthetic"),
                       F.lit(None).cast("array<double>").alias("origin"), F.lit(None).cast("array<double>").alias("partner"))
    return old.unionByName(new)
