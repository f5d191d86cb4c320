"""Classifier, metrics, store and clustering."""

import random

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from aerostrata.ml import forests as fo
from aerostrata.ml import metrics as mm
from aerostrata.ml import models as md


def test_metrics_by_hand(spark):
    pairs = [("x", "x")] * 3 + [("x", "y")] + [("y", "y")] * 2 + [("z", "x")]
    df = spark.createDataFrame(pairs, "a string, p string")
    cm = {(r.actual, r.predicted): r.n for r in mm.confusion_matrix(df, "a", "p").collect()}
    assert cm == {("x", "x"): 3, ("x", "y"): 1, ("y", "y"): 2, ("z", "x"): 1}
    out = {r.label: r for r in mm.classification_metrics(df, "a", "p").collect()}
    assert (out["x"].precision, out["x"].recall, out["x"].support) == (0.75, 0.75, 4)
    assert (out["z"].precision, out["z"].recall, out["z"].f1) == (0, 0, 0)
    avg = out["weighted avg"]
    assert abs(avg.accuracy - 5 / 7) < 1e-6 and abs(avg.precision - (4 * .75 + 2 * 2 / 3) / 7) < 1e-6
    report = mm.per_class_report(df, "a", "p", ["x", "y", "z", "unseen"]).collect()
    assert {r.label: r.support for r in report}["unseen"] == 0


def test_train_store_load_score(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), f"2024-01-{i % 28 + 1:02d}", float(i % 3) + rnd.random() * .1, "LMH"[i % 3])
            for i in range(120)]
    df = spark.createDataFrame(rows, "station_id string, date string, v double, aqi_category string")
    base = str(tmp_path / "models")
    assert md.load_model(spark, base) is None
    assert md.train_classifier(df.limit(5), f"{base}/0", search=False) is None
    md.train_classifier(df, f"{base}/1", search=False, trees=5, depth=3)
    md.register_model(spark, base, 1, "Staging", f"{base}/1", {"trees": 5})
    model = md.load_model(spark, base)
    scored = md.score(df.withColumn("station_id", F.lit("new")), model).collect()
    assert sum(r.predicted_label == r.aqi_category for r in scored) > 110
    assert all(0 < r.confidence <= 1 for r in scored)
    assert md.model_runs(spark, base).count() == 1


def test_grid_search(spark, tmp_path):
    rows = [("ab"[i % 2], i, float(i % 3), "LMH"[i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "station_id string, date int, v double, aqi_category string")
    model = md.train_classifier(df, str(tmp_path / "m"), grid={"numTrees": [2], "maxDepth": [1, 3]})
    assert model.pipeline.stages[2].getMaxDepth() == 3
    done = md.read_summary(spark, str(tmp_path / "m"))
    assert done["best"] == {"numTrees": 2, "maxDepth": 3} and len(done["fold_f1"]) == 2 and done["features"] == 2
    assert all(r.predicted_label == r.aqi_category for r in md.score(df, model).collect())


def test_a_cut_tree_predicts_like_the_counts_of_its_nodes(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(float(rnd.random()), float(i % 7), float(rnd.random() < .3) + float(i % 7 > 3)) for i in range(400)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(spark.createDataFrame(rows, "a double, b double, y double"))
    df = df.withColumn("id", F.monotonically_increasing_id()).cache()
    path = str(tmp_path / "forest")
    RandomForestClassifier(featuresCol="f", labelCol="y", numTrees=7, maxDepth=9, seed=1, leafCol="_leaf").fit(df).write().save(path)
    forest = RandomForestClassificationModel.load(path)
    depths, sizes = [0, 3, 9], [3, 7]
    leaves = fo.cut_leaves(spark, path, depths)
    got = {r.id: r for r in fo.cut_predictions(forest.transform(df), leaves, sizes, depths, 3, "id", ["y"]).collect()}
    nodes = {(r.treeID, r.nodeData.id): r.nodeData for r in spark.read.parquet(f"{path}/data").collect()}

    def plain(row, size, depth):
        votes = [0.0] * 3
        for tree in range(size):
            node, at = nodes[tree, 0], 0
            while node.leftChild >= 0 and at < depth:
                value = (row.a, row.b)[node.split.featureIndex]
                node, at = nodes[tree, node.leftChild if value <= node.split.leftCategoriesOrThreshold[0] else node.rightChild], at + 1
            votes = [v + x / sum(node.impurityStats) for v, x in zip(votes, node.impurityStats)]
        return float(votes.index(max(votes)))

    for row in forest.transform(df).collect():
        assert got[row.id].predictions == [plain(row, n, d) for n in sizes for d in depths]
        assert got[row.id].predictions[-1] == row.prediction and got[row.id].y == row.y
    counts = {(0.0, 0.0): 3, (0.0, 1.0): 1, (1.0, 1.0): 2, (2.0, 0.0): 1}
    assert abs(fo.weighted_f1(counts) - (4 * .75 + 2 * .8) / 7) < 1e-12


def test_points_share_their_fits(spark):
    rows = [(float(i % 5), float(i % 5 > 2), 1.0, i % 3) for i in range(150)]
    df = VectorAssembler(inputCols=["v"], outputCol="f").transform(spark.createDataFrame(rows, "v double, y double, weight double, fold int"))
    forest = RandomForestClassifier(featuresCol="f", labelCol="y", weightCol="weight", seed=1)
    points, scores = fo.search_forests(df, forest, {"numTrees": [2, 4], "maxDepth": [0, 2], "minInstancesPerNode": [1, 60]}, 2)
    assert len(points) == len(scores) == 8 and points[1] == {"numTrees": 2, "maxDepth": 0, "minInstancesPerNode": 60}
    by = {tuple(p.values()): s for p, s in zip(points, scores)}
    assert by[4, 2, 1] == 1.0 > by[4, 0, 1] and by[4, 2, 60] < 1.0


def test_a_thousand_stations(spark, tmp_path):
    rows = [(f"s{i % 1000}", i, float(i % 3), "LMH"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "station_id string, date int, v double, aqi_category string")
    model = md.train_classifier(df, str(tmp_path / "m"), search=False, trees=3, depth=4, max_rows=1500)
    assert md.read_summary(spark, str(tmp_path / "m"))["rows"] < 2000
    assert model.codes.count() == 1000
    assert md.score(df, model).filter("predicted_label = aqi_category").count() > 2900


def test_medians_go_with_the_model(spark, tmp_path):
    rows = [("a", i, float(i % 3), "LMH"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "station_id string, date int, v double, aqi_category string")
    medians = spark.createDataFrame([("a", 1.0)], "station_id string, _median_v double")
    model = md.train_classifier(df, str(tmp_path / "m"), search=False, trees=2, depth=2, medians=medians)
    assert model.medians.collect() == medians.collect()


def test_clusters_are_ranked_by_index(spark):
    rows = [(f"s{i}", float(100 * (i % 3) + i % 2), float(i % 3)) for i in range(12)]
    means = spark.createDataFrame(rows, "station_id string, ispu double, pm25_avg double")
    out = md.cluster_stations(means, ["ispu", "pm25_avg"])
    got = {r.station_id: r.cluster for r in out.collect()}
    assert got == {f"s{i}": i % 3 for i in range(12)}
    assert md.cluster_projection(out, ["ispu", "pm25_avg"]).count() == 12
