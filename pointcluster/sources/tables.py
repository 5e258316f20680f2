"""Sinks and sources of points, scalers, centroids, labels and run metrics.

Every sink replaces what its path held before, once the new rows are complete: a write
that fails leaves the old ones (``functions.durable.replace``). Nulls are stored as they
are, repeated rows as often as they come, and an empty frame as an empty table. Centroids keep the stored form
``cluster_id int, centroid string`` where ``centroid`` is a JSON array, so
files of either side can be read by the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durable import replace

SCALER_SCHEMA = T.StructType(
    [
        T.StructField("min_vals", T.ArrayType(T.DoubleType())),
        T.StructField("max_vals", T.ArrayType(T.DoubleType())),
    ]
)
CENTROID_FILE_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("centroid", T.StringType()),
    ]
)
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("algorithm", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("max_iterations", T.IntegerType()),
        T.StructField("tol", T.DoubleType()),
        T.StructField("seed", T.IntegerType()),
        T.StructField("init_mode", T.StringType()),
        T.StructField("limit", T.IntegerType()),
        T.StructField("test_mode", T.BooleanType()),
        T.StructField("training_cost", T.DoubleType()),
        T.StructField("silhouette_score", T.DoubleType()),
        T.StructField("cluster_sizes", T.StringType()),
    ]
)


def _replace(rows: DataFrame, path: str, form: str) -> None:
    replace(rows.sparkSession, path, rows.write.format(form).save)


def write_points(points: DataFrame, path: str) -> None:
    _replace(points.select("id", "features"), path, "parquet")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("id", "features")


def write_scaler(scaler: DataFrame, path: str) -> None:
    _replace(scaler.select("min_vals", "max_vals"), path, "json")


def read_scaler(spark: SparkSession, path: str) -> DataFrame:
    scaler = spark.read.schema(SCALER_SCHEMA).json(path)
    if scaler.isEmpty():
        raise ValueError(f"no scaler at {path}")
    return scaler


def write_centroids(centroids: DataFrame, path: str) -> None:
    rows = centroids.select(
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.to_json("centroid").alias("centroid"),
    )
    _replace(rows, path, "json")


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster_id int, centroid array<double>)`` sorted by id."""
    stored = spark.read.schema(CENTROID_FILE_SCHEMA).json(path)
    if stored.isEmpty():
        raise ValueError(f"no centroids at {path}")
    return stored.select(
        "cluster_id", F.from_json("centroid", "array<double>").alias("centroid")
    ).orderBy("cluster_id")


def write_labels(labels: DataFrame, path: str) -> None:
    _replace(labels, path, "parquet")


def read_labels(spark: SparkSession, path: str, label_type: str = "int") -> DataFrame:
    """Labels with normalised types; ``label_type`` is 'int' or 'string'."""
    return spark.read.parquet(path).select(
        F.col("point_id").cast("string").alias("point_id"),
        F.col("cluster_id").cast(label_type).alias("cluster_id"),
    )


def write_predictions(predictions: DataFrame, path: str) -> None:
    _replace(predictions, path, "parquet")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """``cluster_sizes`` is stored as JSON text."""
    if isinstance(metrics.schema["cluster_sizes"].dataType, T.ArrayType):
        metrics = metrics.withColumn("cluster_sizes", F.to_json("cluster_sizes"))
    _replace(metrics, path, "json")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)
