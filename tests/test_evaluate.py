import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointcluster import (
    cluster_sizes,
    distinct_clusters,
    in_top_clusters,
    inertia,
    join_labels,
    kmeans,
    label_overlap,
    noise_summary,
    silhouette_euclid,
    silhouette_sq,
    top_clusters,
    without_noise,
)
from pointcluster.operators import evaluate
from pointcluster.plans.mlkmeans import ml_kmeans


def silhouette(x, labels, power):
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(axis=2)) ** power
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.fixture(scope="module")
def labelled(random_points):
    x, points = random_points(240)
    found = kmeans(points, 4, max_iterations=3, tol=0).assign()
    labels = np.array([r["cluster_id"] for r in found.orderBy("id").collect()])
    return x, labels, found


def test_squared_silhouette(labelled, monkeypatch):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    x, labels, found = labelled
    score = silhouette_sq(found).first()[0]
    assert score == pytest.approx(silhouette(x, labels, 2), abs=1e-12)
    frame = found.select(array_to_vector("features").alias("features"), "cluster_id")
    ml = ClusteringEvaluator(predictionCol="cluster_id").evaluate(frame)
    assert score == pytest.approx(ml, abs=1e-12)
    monkeypatch.setattr(evaluate, "unrolls", lambda k, d: False)
    assert silhouette_sq(found).first()[0] == pytest.approx(score, abs=1e-12)


def test_one_point_cluster_scores_zero(spark, monkeypatch):
    rows = [([0.0, 0.0], 0), ([0.0, 1.0], 0), ([5.0, 5.0], 1)]
    df = spark.createDataFrame(rows, "features array<double>, cluster_id int")
    x, labels = np.array([r[0] for r in rows]), np.array([0, 0, 1])
    want = silhouette(x, labels, 2)
    assert silhouette_sq(df).first()[0] == pytest.approx(want)
    monkeypatch.setattr(evaluate, "unrolls", lambda k, d: False)
    assert silhouette_sq(df).first()[0] == pytest.approx(want)


def test_inertia_by_columns_and_blocks(labelled, spark, monkeypatch):
    from pointcluster.operators.nearest import centroid_frame

    x, labels, found = labelled
    centers = [x[labels == j].mean(axis=0) for j in range(4)]
    want = sum(((x[labels == j] - c) ** 2).sum() for j, c in enumerate(centers))
    frame = centroid_frame(spark, centers)
    assert inertia(found, frame).first()[0] == pytest.approx(want)
    monkeypatch.setattr(evaluate, "unrolls", lambda k, d: False)
    assert inertia(found, frame).first()[0] == pytest.approx(want)


def test_euclidean_silhouette(labelled):
    x, labels, found = labelled
    row = silhouette_euclid(found, "lloyd", 1000).first()
    assert row["silhouette_score"] == pytest.approx(silhouette(x, labels, 1), abs=1e-12)
    assert (row["algorithm"], row["k"], row["n_points"], row["silhouette_sample_size"]) == (
        "lloyd",
        4,
        240,
        240,
    )
    few = silhouette_euclid(found, "lloyd", 50).first()
    assert few["silhouette_sample_size"] == 50 and few["n_points"] == 240


@pytest.mark.parametrize("block", [16, 50, 100])
def test_euclidean_silhouette_in_blocks(labelled, monkeypatch, block):
    """Clusters larger than a block, whole small ones, and one of a single point."""
    x, labels, found = labelled
    monkeypatch.setattr(evaluate, "SAMPLE_BLOCK", block)
    split = found.withColumn("cluster_id", F.expr("IF(id = 7, 99, IF(id < 30, id % 3 + 50, cluster_id))"))
    own = np.where(np.arange(240) < 30, np.arange(240) % 3 + 50, labels)
    own[7] = 99
    score = silhouette_euclid(split, "x", 1000).first()["silhouette_score"]
    assert score == pytest.approx(silhouette(x, own, 1), abs=1e-12)


def test_squared_silhouette_beyond_one_block(labelled, monkeypatch):
    x, labels, found = labelled
    monkeypatch.setattr(evaluate, "SCORE_CLUSTERS", 3)
    monkeypatch.setattr(evaluate, "SCORE_ROWS", 100)
    many = found.withColumn("cluster_id", F.expr("concat('it''s ', cast(cluster_id * 10 + id % 5 as string))"))
    own = labels * 10 + np.arange(240) % 5
    assert silhouette_sq(many).first()[0] == pytest.approx(silhouette(x, own, 2), abs=1e-12)


def test_labels_with_quotes_and_far_data(labelled):
    x, labels, found = labelled
    quoted = found.withColumn("cluster_id", F.concat(F.lit("o'"), F.col("cluster_id").cast("string")))
    far = quoted.withColumn("features", F.transform("features", lambda v: v + 1e7))
    want = silhouette(x, labels, 2)
    assert silhouette_sq(quoted).first()[0] == pytest.approx(want, abs=1e-12)
    assert silhouette_sq(far).first()[0] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("k", [3, 30])
@pytest.mark.parametrize("bad", [[1.0, None], [float("nan"), 0.0], None])
def test_null_and_nan_features_are_errors(spark, k, bad):
    from pointcluster import assign_nearest, dbscan, elkan_kmeans, eps_neighbors
    from pointcluster.operators.nearest import centroid_frame

    rows = [(i, [float(i), float(i % 7)]) for i in range(40)] + [(99, bad)]
    points = spark.createDataFrame(rows, "id long, features array<double>")
    centers = [[float(j), float(j % 5)] for j in range(k)]
    frame = centroid_frame(spark, centers)
    labelled = points.withColumn("cluster_id", F.lit(0))
    for work in (
        lambda: assign_nearest(points, frame).collect(),
        lambda: kmeans(points, k, 2, init=centers),
        lambda: elkan_kmeans(points, k, 2, init=centers),
        lambda: inertia(labelled, frame).collect(),
        lambda: silhouette_sq(labelled).collect(),
        lambda: eps_neighbors(points, 1.0).collect(),
        lambda: dbscan(points, 1.0, 2, include_noise=True).collect(),
    ):
        with pytest.raises(Exception, match="null or NaN feature"):
            work()


@pytest.mark.parametrize("k", [3, 30])
@pytest.mark.parametrize("label", [-1, 1000, None])
def test_labels_without_a_centroid_are_errors(spark, k, label):
    from pointcluster.operators.nearest import centroid_frame

    frame = centroid_frame(spark, [[float(j), 0.0] for j in range(k)])
    rows = [([1.0, 1.0], 1), ([5.0, 5.0], label)]
    df = spark.createDataFrame(rows, "features array<double>, cluster_id int")
    with pytest.raises(Exception, match="label without a centroid"):
        inertia(df, frame).collect()


def test_nearest_of_many_centers_is_exact(spark, make_points):
    from pointcluster import assign_nearest
    from pointcluster.operators.nearest import centroid_frame

    rng = np.random.default_rng(3)
    x = np.round(rng.random((300, 2)), 2) + 1e6
    centers = np.round(rng.random((50, 2)), 2) + 1e6
    centers[40:] = centers[:10]  # ties: the lower index wins
    found = assign_nearest(make_points([tuple(v) for v in x]), centroid_frame(spark, centers))
    d2 = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    for r in found.collect():
        assert r["cluster_id"] == d2[r["id"]].argmin() and r["dist_sq"] == d2[r["id"]].min()


def test_one_label_has_no_silhouette(labelled):
    _, _, found = labelled
    one = found.withColumn("cluster_id", found["cluster_id"] * 0)
    assert math.isnan(silhouette_euclid(one, "x", 100).first()["silhouette_score"])
    assert math.isnan(silhouette_sq(one).first()[0])
    with pytest.raises(ValueError):
        silhouette_euclid(found, "x", 0)
    # no cap: a sample size beyond the rows takes all rows
    assert silhouette_euclid(found, "x", 10**9).first()["silhouette_sample_size"] == 240


def test_counts(spark):
    rows = [("a", "7"), ("b", "7"), ("c", "2"), ("d", "-1"), ("e", "2"), ("f", "9")]
    labels = spark.createDataFrame(rows, "point_id string, cluster_id string")
    assert [tuple(r) for r in top_clusters(without_noise(labels), 2).collect()] == [
        ("2", 2),
        ("7", 2),
    ]
    kept = {r["point_id"] for r in in_top_clusters(without_noise(labels), 2).collect()}
    assert kept == {"a", "b", "c", "e"}
    assert tuple(noise_summary(labels).first()) == (6, 1, 3)
    assert distinct_clusters(labels).first()[0] == 4
    assert sum(r["count"] for r in cluster_sizes(labels).collect()) == 6


def test_unlabelled_points_drop_out(spark, make_points):
    labels = spark.createDataFrame([("1", 5)], "point_id string, cluster_id int")
    rows = join_labels(make_points([(0, 0), (1, 1)]), labels).collect()
    assert [(r["id"], r["cluster_id"]) for r in rows] == [(1, 5)]


def test_overlap(spark):
    rows = [(1, 5), (1, 3), (1, 5), (2, 5), (2, 5)]
    found = label_overlap(spark.createDataFrame(rows, "point_id long, cluster_id long"))
    assert [tuple(r) for r in found.collect()] == [(1, [3, 5])]


def test_ml_run_is_saved_and_read_back(random_points, spark, tmp_path):
    from pointcluster.sources import tables

    _, points = random_points(200)
    run = ml_kmeans(points, 3, compute_silhouette=True)
    run.save(str(tmp_path / "ml"))
    row = tables.read_metrics(spark, str(tmp_path / "ml/metrics_json")).first()
    assert row["algorithm"] == "pyspark.ml.clustering.KMeans" and row["k"] == 3
    assert -1 <= row["silhouette_score"] <= 1 and row["training_cost"] > 0
    assert tables.read_labels(spark, str(tmp_path / "ml/assignments_parquet")).count() == 200
    assert len(tables.read_centroids(spark, str(tmp_path / "ml/centroids_json")).collect()) == 3
    assert ml_kmeans(points, 3, limit=50).labels.count() == 50
    with pytest.raises(ValueError):
        ml_kmeans(points, 3, init_mode="best")


def test_run_metrics_keeps_labels_of_any_type(spark, tmp_path):
    from pointcluster import run_metrics
    from pointcluster.sources import tables

    labels = spark.createDataFrame(
        [("1", "123456789012"), ("2", "123456789012"), ("3", "-1"), ("4", None)],
        "point_id string, cluster_id string",
    )
    found = run_metrics(labels, "dbscan", 0, 0, 0.0, 0, "none", 0.0)
    assert [tuple(r) for r in found.first()["cluster_sizes"]] == [(None, 1), ("-1", 1), ("123456789012", 2)]
    tables.write_metrics(found, str(tmp_path / "m"))
    assert '"123456789012"' in tables.read_metrics(spark, str(tmp_path / "m")).first()["cluster_sizes"]
    assert run_metrics(labels.limit(0), "dbscan", 0, 0, 0.0, 0, "none", 0.0).first()["cluster_sizes"] == []
