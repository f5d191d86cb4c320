"""Classifier, clustering, model store and scoring on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (
    PCA, IndexToString, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from aerostrata.ml.forests import search_forests
from aerostrata.operators.features import feature_columns, has_rows, with_weights
from aerostrata.operators.series import ordinal_codes
from aerostrata.sinks.tables import read_or_none
from aerostrata.schema import CLUSTER_MEASURES

# Search grid, folds and seed.  Spark's deepest tree is 30 levels.
GRID = {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2]}
FOLDS = 3
SEED = 42
CLUSTERS = 3
ROWS_A_PART = 4000
# So much memory lets one pass over the rows grow a whole level of all trees.
LEVEL_MB = 1024


class StoredModel(NamedTuple):
    """A forest with what scoring needs beside it: station codes and the medians of its training rows."""

    pipeline: PipelineModel
    codes: DataFrame
    medians: DataFrame | None
    version: str


def classifier(train: DataFrame, label: str, features: Sequence[str], trees: int = 100,
               depth: int = 10) -> Pipeline:
    """Assembled features, weighted forest and readable prediction; labels are in alphabetical order.

    The station code is a plain number among the features, so any number of stations will do.
    """
    labels = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc",
                           handleInvalid="keep")
    fitted = labels.fit(train)
    assembler = VectorAssembler(inputCols=[*features, "station_encoded"], outputCol="_features",
                                handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", weightCol="weight", predictionCol="_prediction",
        probabilityCol="_probability", rawPredictionCol="_raw",
        numTrees=trees, maxDepth=depth, maxBins=32, seed=SEED,
        maxMemoryInMB=LEVEL_MB, cacheNodeIds=True)
    names = IndexToString(inputCol="_prediction", outputCol="predicted_label",
                          labels=list(fitted.labels) + ["__unknown"])
    return Pipeline(stages=[fitted, assembler, forest, names])


def train_classifier(train: DataFrame, path: str, label: str = "aqi_category",
                     station: str = "station_id", order: Sequence[str] = ("date",),
                     search: bool = True, min_rows: int = 10, parallelism: int = 8,
                     trees: int = 100, depth: int = 10, partitions: int | None = None,
                     grid: dict[str, Sequence[int]] = GRID, max_rows: int = 50_000,
                     medians: DataFrame | None = None, version: str = "1") -> StoredModel | None:
    """Fit the forest, with the grid search unless told otherwise, and store it below `path`.

    The forest is fitted on about `max_rows` labelled rows at most, chosen by a hash of their
    key; folds are another hash, so both are the same on every run.  Stored beside the model are
    the code of every station, the `medians` its features were imputed with, and a summary of
    the fit.  Returns the stored model read back, or None when there are too few rows.
    """
    if not has_rows(train, min_rows):
        return None
    spark = train.sparkSession
    features = [c for c in feature_columns(train) if c not in ("split", "station_encoded")]
    ordinal_codes(train, station, "station_encoded").write.mode("overwrite").parquet(f"{path}/codes")
    codes = spark.read.parquet(f"{path}/codes")
    if medians is not None:
        medians.write.mode("overwrite").parquet(f"{path}/medians")
    total = train.count()
    share = int(min(1.0, max_rows / total) * (1 << 30))
    picked = train.filter(F.pmod(F.xxhash64(F.lit("rows"), station, *order), F.lit(1 << 30)) < share)
    rows = with_weights(picked, label).join(codes, station).withColumn(
        "fold", F.pmod(F.xxhash64(station, *order), F.lit(FOLDS)).cast("int"))
    # The trees read the rows once per level: keep them, in as many parts as they fill.
    parts = partitions or max(1, min(spark.sparkContext.defaultParallelism, min(total, max_rows) // ROWS_A_PART))
    rows = rows.repartition(parts, station, *order).persist(StorageLevel.MEMORY_AND_DISK)
    ready = rows
    summary = {"features": len(features) + 1, "mode": "grid" if search else "single", "rows": rows.count()}
    try:
        stages = classifier(rows, label, features, trees, depth)
        indexer, assembler, forest, names = stages.getStages()
        # Assembled and indexed once, so that a fit reads nothing but what its trees need.
        ready = assembler.transform(indexer.transform(rows)).select("_features", "_label", "weight", "fold").persist(StorageLevel.MEMORY_AND_DISK)
        best, scores = {"numTrees": trees, "maxDepth": depth}, []
        if search:
            points, scores = search_forests(ready, forest, grid, len(indexer.labels) + 1, "fold", FOLDS, parallelism)
            best = points[scores.index(max(scores))]
        fitted = forest.copy({forest.getParam(k): v for k, v in best.items()}).fit(ready)
        model = PipelineModel(stages=[indexer, assembler, fitted, names])
        summary |= {"best": best, "fold_f1": scores}
        model.write().overwrite().save(f"{path}/model")
    finally:
        ready.unpersist()
        rows.unpersist()
    spark.createDataFrame([(json.dumps(summary),)], "summary string").write.mode("overwrite").parquet(f"{path}/summary")
    return read_model(spark, path, version)


def read_model(spark: SparkSession, path: str, version: str) -> StoredModel:
    return StoredModel(PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/codes"),
                       read_or_none(spark, f"{path}/medians"), version)


def read_summary(spark: SparkSession, path: str) -> dict:
    """What was fitted: rows, features, mode, best parameters and the mean F1 of every grid point."""
    return json.loads(spark.read.parquet(f"{path}/summary").first()["summary"])


def score(df: DataFrame, model: StoredModel, station: str = "station_id") -> DataFrame:
    """Add predicted label and confidence, the highest class probability.

    A station that the model has not seen gets the code -1; remaining nulls count as 0.
    """
    coded = df.drop("station_encoded").join(model.codes, station, "left").fillna(-1, subset=["station_encoded"])
    inputs = model.pipeline.stages[1].getInputCols()
    filled = coded.withColumns({f"_own_{c}": F.col(c) for c in inputs if c in df.columns}).fillna(0, subset=inputs)
    confidence = F.array_max(vector_to_array("_probability"))
    scored = model.pipeline.transform(filled)
    own = [F.col(f"_own_{c}").alias(c) if c in inputs else F.col(c) for c in df.columns if c != "station_encoded"]
    own += [F.col("station_encoded")] if "station_encoded" in df.columns else []
    return scored.select(*own, "predicted_label", confidence.alias("confidence")).select(
        *df.columns, "predicted_label", "confidence")


# --- model store -------------------------------------------------------------------

MANIFEST = "version long, stage string, path string, summary string, created_at timestamp"


def register_model(spark: SparkSession, base: str, version: int, stage: str, path: str,
                   summary: dict) -> None:
    """Append one row to the manifest of stored models."""
    row = spark.createDataFrame([(version, stage, path, json.dumps(summary))],
                                "version long, stage string, path string, summary string")
    row.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(f"{base}/manifest")


def model_runs(spark: SparkSession, base: str) -> DataFrame:
    """Training history: one row per stored model with its summary."""
    found = read_or_none(spark, f"{base}/manifest")
    return spark.createDataFrame([], MANIFEST) if found is None else found


def newest_model(spark: SparkSession, base: str, stage: str = "Production") -> tuple[str, str] | None:
    """Version and path of the newest model of the stage, else of any stage, else None."""
    wanted = (F.col("stage") == stage).desc()
    best = model_runs(spark, base).orderBy(wanted, F.desc("version"), F.desc("created_at")).first()
    return (str(best["version"]), best["path"]) if best else None


def load_model(spark: SparkSession, base: str, stage: str = "Production") -> StoredModel | None:
    best = newest_model(spark, base, stage)
    return read_model(spark, best[1], best[0]) if best else None


def training_summary(split: DataFrame, metrics: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """One row: sample counts, overall metrics and cluster sizes. Each input is read once."""
    out = split.agg(F.count_if(F.col("split") == "train").alias("train_samples"),
                    F.count_if(F.col("split") == "test").alias("test_samples"))
    overall = metrics.filter("label = 'weighted avg'").select(F.struct(
        "accuracy", "precision", "recall", F.col("f1").alias("f1_score")).alias("m"))
    out = out.withColumn("m", overall.scalar()).select("train_samples", "test_samples", "m.*")
    if clusters is not None:
        sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).agg(
            F.array_join(F.sort_array(F.collect_list(
                F.concat_ws(":", F.col("cluster").cast("string"), F.col("n").cast("string")))), ",")
            .alias("sizes"))
        out = out.withColumn("cluster_sizes", sizes.scalar())
    return out


# --- clustering --------------------------------------------------------------------

def _scaled(measures: Sequence[str]) -> list:
    return [VectorAssembler(inputCols=list(measures), outputCol="_raw_features"),
            StandardScaler(inputCol="_raw_features", outputCol="_features", withMean=True, withStd=True)]


def cluster_stations(means: DataFrame, measures: Sequence[str] = CLUSTER_MEASURES,
                     index: str = "ispu", k: int = CLUSTERS) -> DataFrame:
    """K-means over standardised station means; clusters are numbered by rising mean index."""
    pipe = Pipeline(stages=[*_scaled(measures), KMeans(
        featuresCol="_features", predictionCol="_cluster", k=k, seed=SEED, initSteps=10)])
    assigned = pipe.fit(means).transform(means).drop("_raw_features", "_features")
    ranks = assigned.groupBy("_cluster").agg(F.avg(index).alias("_m")).withColumn(
        "cluster", F.row_number().over(Window.orderBy("_m")) - 1).drop("_m")
    return assigned.join(ranks, "_cluster").drop("_cluster")


def cluster_projection(clustered: DataFrame, measures: Sequence[str] = CLUSTER_MEASURES) -> DataFrame:
    """First two principal components of the standardised station means."""
    pipe = Pipeline(stages=[*_scaled(measures), PCA(k=2, inputCol="_features", outputCol="_pca")])
    pc = vector_to_array("_pca")
    return pipe.fit(clustered).transform(clustered).select(
        "station_id", "cluster", pc[0].alias("pc1"), pc[1].alias("pc2"))
