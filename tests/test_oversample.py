"""Oversampling and its neighbour search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from aerostrata.operators.oversample import BLOCK, nearest_in_class, oversample


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=(2400, 5)), rng.normal(size=(600, 5)) * 0.01 + 3])
    label = ["hot"] * 2700 + ["rare"] * 300
    points = spark.createDataFrame([(c, i, x.tolist()) for i, (c, x) in enumerate(zip(label, v))], "c string, id long, v array<double>")
    rows = nearest_in_class(points, 5).collect()
    assert len(rows) == 3000
    hits = 0
    for r in rows:
        assert r.id not in [x.id for x in r.near] and all(label[x.id] == r.c for x in r.near)
        assert [x.d for x in r.near] == sorted(x.d for x in r.near)
        own = np.array([i for i in range(3000) if label[i] == r.c and i != r.id])
        best = own[np.argsort(((v[own] - v[r.id]) ** 2).sum(axis=1))[:5]]
        hits += len(set(best) & {x.id for x in r.near})
    assert hits >= 0.9 * 5 * 3000


def test_classes_reach_the_largest(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(x), float(y), "t") for x, y in rng.normal(size=(900, 2))] + [("b", float(x), float(y), "t") for x, y in rng.normal(size=(70, 2)) + 9]
    rows += [("one", 1.0, 2.0, None)] * 3 + [("gap", None, 2.0, "t"), ("gap", float("nan"), 1.0, "t"), (None, 1.0, 1.0, "t")]
    df = spark.createDataFrame(rows, "kind string, x double, y double, c string")
    out = oversample(df, "kind", ["x", "y"])
    got = {(r.kind, r.synthetic): r["count"] for r in out.groupBy("kind", "synthetic").count().collect()}
    assert got == {("a", False): 900, ("b", False): 70, ("b", True): 830, ("one", False): 3, ("one", True): 897, ("gap", False): 2, (None, False): 1}
    b = {(r.x, r.y) for r in df.filter("kind = 'b'").collect()}
    new = out.filter("synthetic").collect()
    for r in new:
        assert r.c is None
        o, p, z = np.array(r.origin), np.array(r.partner), np.array([r.x, r.y])
        assert np.all(z >= np.minimum(o, p) - 1e-12) and np.all(z <= np.maximum(o, p) + 1e-12)
        if r.kind == "b":
            assert tuple(r.origin) in b and tuple(r.partner) in b and r.origin != r.partner
            nearest = sorted(((x - r.origin[0]) ** 2 + (y - r.origin[1]) ** 2) for x, y in b)
            assert ((o - p) ** 2).sum() <= nearest[5] + 1e-12
        else:
            assert (r.x, r.y) == (1.0, 2.0)
    uses = {}
    for r in new:
        if r.kind == "b":
            uses[tuple(r.origin)] = uses.get(tuple(r.origin), 0) + 1
    assert len(uses) == 70 and max(uses.values()) - min(uses.values()) <= 1
    again = oversample(df.repartition(5), "kind", ["x", "y"]).filter("synthetic").collect()
    assert sorted((r.kind, r.x, r.y) for r in again) == sorted((r.kind, r.x, r.y) for r in new)
    assert oversample(df.limit(0), "kind", ["x", "y"]).count() == 0


def test_blocks_stay_small(spark):
    """Vectors along a line fall into few cells, which are cut again: a row meets far fewer rows than its class holds."""
    points = spark.range(20_000).select(F.lit("c").alias("c"), "id", F.array(F.col("id") / 7.0, F.col("id") / 3.0).alias("v"))
    near = nearest_in_class(points, 2, k=2, tables=3)
    assert near.filter(F.size("near") == 2).count() == 20_000
    assert near.filter(F.abs(F.col("near")[0]["id"] - F.col("id")) == 1).count() >= 0.99 * 20_000
    assert BLOCK < 20_000 / 50


def test_equally_near_ones_go_by_id(spark):
    """Of the points of a grid many are equally near: the smallest ids count, in their order."""
    v = {i: (float(i % 12), float(i // 12)) for i in range(144)}
    points = spark.createDataFrame([("c", 143 - i, list(x)) for i, x in v.items()], "c string, id long, v array<double>")
    v = {143 - i: x for i, x in v.items()}
    for r in nearest_in_class(points, 2, k=3).collect():
        best = sorted((((x[0] - v[r.id][0]) ** 2 + (x[1] - v[r.id][1]) ** 2) ** 0.5, i) for i, x in v.items() if i != r.id)[:3]
        assert [(x.d, x.id) for x in r.near] == best
