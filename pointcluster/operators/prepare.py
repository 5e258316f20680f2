"""Cleaning, feature assembly and min-max scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dimension, features_column, lit
from ..sources.tables import SCALER_SCHEMA

# The city's bounding box, both ends exclusive.
CITY_BOX = {
    "pickup_longitude": (-74.25, -73.7),
    "pickup_latitude": (40.5, 40.9),
}

# Fixed value: what a zero range is replaced by before dividing.
ZERO_RANGE = 1e-9


def filter_box(
    df: DataFrame,
    box: Mapping[str, tuple[float, float]] = CITY_BOX,
    positive: Sequence[str] = ("passenger_count",),
) -> DataFrame:
    """Rows strictly inside ``box`` whose ``positive`` columns exceed zero.

    Nulls fail the comparison and are dropped. The conjunction is pushed into
    the scan.
    """
    tests = [f"{c} > {lit(lo)} AND {c} < {lit(hi)}" for c, (lo, hi) in box.items()]
    tests += [f"{c} > 0" for c in positive]
    return df.where(" AND ".join(tests)) if tests else df


def with_hour(df: DataFrame, timestamp: str, out: str = "pickup_hour") -> DataFrame:
    return df.withColumn(out, F.hour(timestamp))


def assemble(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Named columns -> points ``(id, features array<double>)``."""
    return df.select(F.col(id_column).alias("id"), features_column(columns))


def as_vectors(points: DataFrame) -> DataFrame:
    """Points with ``features`` as an ML dense vector."""
    from pyspark.ml.functions import array_to_vector

    return points.withColumn("features", array_to_vector("features"))


def fit_minmax(points: DataFrame) -> DataFrame:
    """One-row scaler ``(min_vals, max_vals)``; a single partial aggregate."""
    d = dimension(points)
    aggs = [f"min(features[{i}]) AS lo{i}" for i in range(d)]
    aggs += [f"max(features[{i}]) AS hi{i}" for i in range(d)]
    row = points.selectExpr(*aggs).first()
    if row["lo0"] is None:
        raise ValueError("no points")
    data = ([row[f"lo{i}"] for i in range(d)], [row[f"hi{i}"] for i in range(d)])
    return points.sparkSession.createDataFrame([data], SCALER_SCHEMA)


def scaler_bounds(scaler: DataFrame) -> tuple[list[float], list[float]]:
    row = scaler.select("min_vals", "max_vals").first()
    if row is None:
        raise ValueError("the scaler holds no row")
    return list(row["min_vals"]), list(row["max_vals"])


def scale(points: DataFrame, scaler: DataFrame) -> DataFrame:
    """``(x - min) / (max - min)`` per feature, a zero range counting as 1e-9.

    With bounds from other points the result may leave [0, 1].
    """
    los, his = scaler_bounds(scaler)
    scaled = [
        F.expr(f"(features[{i}] - {lit(lo)}) / {lit((hi - lo) or ZERO_RANGE)}")
        for i, (lo, hi) in enumerate(zip(los, his))
    ]
    return _replace_features(points, scaled)


def inverse_scale(points: DataFrame, scaler: DataFrame) -> DataFrame:
    """``s * (max - min) + min``; a zero range gives back the constant."""
    los, his = scaler_bounds(scaler)
    raw = [
        F.expr(f"features[{i}] * {lit(hi - lo)} + {lit(lo)}")
        for i, (lo, hi) in enumerate(zip(los, his))
    ]
    return _replace_features(points, raw)


def _replace_features(points: DataFrame, values: list) -> DataFrame:
    new = F.array(*values).alias("features", metadata={"dimension": len(values)})
    return points.select(*[new if c == "features" else c for c in points.columns])
