"""Grid search over forests that share their trees.

A forest of the most trees and the greatest depth holds the smaller points of a grid: fewer trees are
its first ones, and a shallower tree is the same tree cut off, since every node keeps the class
counts of the rows that reached it. So only what changes the growing of a tree, such as the smallest
leaf, needs a fit of its own for each fold; all other points are read from it in one scoring job.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.session import run_path

def cut_leaves(spark: SparkSession, path: str, depths: Sequence[int]) -> DataFrame:
    """Rows (tree, leaf, shares) of a stored forest: for each depth, the class shares of the node where the
    way to this leaf ends when the tree is cut there. Leaves are numbered in the order of the tree.

    The nodes pass through the driver, which holds a fitted forest anyway.
    """
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.impurityStats").toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, own, left, right = (nodes.column(i).to_numpy() for i in range(4))
    stats = nodes.column(4).combine_chunks().values.to_numpy().reshape(len(tree), -1)
    stats = stats / np.maximum(stats.sum(1, keepdims=True), 1e-300)
    first = np.searchsorted(tree, tree)  # a tree's nodes are numbered from 0
    inner, leaf = left >= 0, np.flatnonzero(left < 0)
    ends = np.repeat(np.flatnonzero(own == 0)[:, None], len(depths), 1)
    at, level, reached = ends[:, 0] if len(depths) else np.flatnonzero(own == 0), 0, np.zeros((len(tree), len(depths)), np.int64)
    while len(at):
        reached[at] = ends
        on, level = inner[at], level + 1
        at, ends = at[on], ends[on]
        at = np.concatenate([first[at] + left[at], first[at] + right[at]])
        ends = np.where(np.array(depths) >= level, at[:, None], np.concatenate([ends, ends]))
    shares = pa.FixedSizeListArray.from_arrays(pa.array(stats[reached[leaf]].ravel()), max(1, len(depths) * stats.shape[1])).cast(pa.list_(pa.float64()))
    number = np.arange(len(leaf)) - np.searchsorted(tree[leaf], tree[leaf])
    return spark.createDataFrame(pa.table({"tree": tree[leaf].astype(np.int32), "leaf": number.astype(np.int32), "shares": shares}))


def cut_predictions(scored: DataFrame, leaves: DataFrame, sizes: Sequence[int], depths: Sequence[int], classes: int,
                    key: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of `scored` (with `_leaf`, the leaves it reaches): key, keep, predictions, one for each size and
    depth. Shares of the trees are summed; of equal sums the first class wins."""
    reached = scored.select(key, *keep, F.posexplode(vector_to_array("_leaf")).alias("_tree", "_at"))
    met = reached.join(leaves, (F.col("_tree") == F.col("tree")) & (F.col("_at").cast("int") == F.col("leaf")))
    votes = [F.array(*[F.sum(F.when(F.col("_tree") < n, F.col("shares")[d * classes + c]).otherwise(0.0)) for c in range(classes)])
             for n in sizes for d in range(len(depths))]
    summed = met.groupBy(key, *keep).agg(F.array(*votes).alias("_votes"))
    return summed.select(key, *keep, F.transform("_votes", lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("double")).alias("predictions"))


def weighted_f1(counts: dict[tuple[float, float], int]) -> float:
    """From how often each (label, prediction) occurs; 0 where a class is never predicted right."""
    total, out = sum(counts.values()), 0.0
    for label in {a for a, _ in counts}:
        hit = counts.get((label, label), 0)
        support, named = (sum(n for k, n in counts.items() if k[i] == label) for i in (0, 1))
        out += support * (2 * hit / (support + named))
    return out / total if total else 0.0


def search_forests(rows: DataFrame, forest: RandomForestClassifier, grid: dict[str, Sequence[int]], classes: int,
                   fold: str = "fold", folds: int = 3, parallelism: int = 6) -> tuple[list[dict], list[float]]:
    """The points of the grid, in its order, and their weighted F1, the mean over the folds.

    `rows` has features, label and weight as `forest` wants them, and its fold. numTrees and maxDepth are
    read from shared fits; every combination of the others is fitted once a fold.
    """
    spark = rows.sparkSession
    points = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    sizes, depths = sorted(grid.get("numTrees", [forest.getNumTrees()])), sorted(grid.get("maxDepth", [forest.getMaxDepth()]))
    grown = [k for k in grid if k not in ("numTrees", "maxDepth")]
    label, key = forest.getLabelCol(), "_row"
    while key in rows.columns:
        key = f"_{key}"
    numbered = rows.withColumn(key, F.monotonically_increasing_id())

    def fit(values: tuple, held: int) -> dict[tuple, dict]:
        own = dict(zip(grown, values, strict=True)) | {"numTrees": sizes[-1], "maxDepth": depths[-1]}
        path = run_path(spark, "search-forest")
        found = forest.copy({forest.getParam(k): v for k, v in own.items()}).setLeafCol("_leaf").fit(rows.filter(F.col(fold) != held))
        found.write().save(path)
        # Scored as read back: a fitted model may hold its session.
        scored = RandomForestClassificationModel.load(path).transform(numbered.filter(F.col(fold) == held))
        cut = cut_predictions(scored, cut_leaves(spark, path, depths), sizes, depths, classes, key, [label])
        counted = cut.select(label, F.posexplode("predictions").alias("point", "said")).groupBy("point", label, "said").count()
        out = defaultdict(dict)
        for point, a, said, n in counted.collect():
            out[(sizes[point // len(depths)], depths[point % len(depths)], *values)][a, said] = n
        return out

    fits = list(product(product(*(grid[k] for k in grown)), range(folds)))
    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(lambda job: fit(*job), fits))
    scores = []
    for p in points:
        name = (p.get("numTrees", sizes[-1]), p.get("maxDepth", depths[-1]), *(p[k] for k in grown))
        scores.append(sum(weighted_f1(d[name]) for d in done if name in d) / folds)
    return points, scores
