"""Raw trips to scaled points, and new trips to predicted clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nearest import assign_nearest
from ..operators.prepare import CITY_BOX, assemble, filter_box, fit_minmax, scale
from ..operators.sample import raw_limit
from ..sources.tables import write_points, write_scaler

TEST_ROWS = 1000


def preprocess(
    raw: DataFrame,
    columns: Sequence[str] = ("pickup_longitude", "pickup_latitude"),
    id_column: str = "id",
    box: Mapping[str, tuple[float, float]] = CITY_BOX,
    positive: Sequence[str] = ("passenger_count",),
    test_mode: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Filter, assemble and scale; returns (points, scaler).

    ``test_mode`` takes the first 1000 raw rows by id, before the filter.
    """
    if test_mode:
        raw = raw_limit(raw, TEST_ROWS, id_column)
    points = assemble(filter_box(raw, box, positive), id_column, columns)
    scaler = fit_minmax(points)
    return scale(points, scaler), scaler


def preprocess_to(raw: DataFrame, output: str, scaler_output: str | None = None, **options) -> None:
    """Write points as Parquet and the scaler as JSON, replacing old output."""
    points, scaler = preprocess(raw, **options)
    write_points(points, output)
    write_scaler(scaler, scaler_output or f"{output.rstrip('/')}_scaler_json")


def predict_nearest(
    raw: DataFrame,
    scaler: DataFrame,
    centroids: DataFrame,
    columns: Sequence[str] = ("pickup_longitude", "pickup_latitude"),
    id_column: str = "id",
    box: Mapping[str, tuple[float, float]] = CITY_BOX,
    positive: Sequence[str] = ("passenger_count",),
    names: Sequence[str] = ("scaled_longitude", "scaled_latitude"),
) -> DataFrame:
    """``(point_id string, cluster_id int, <scaled features>)``.

    One narrow stage: filter, scale with the saved bounds, nearest centroid.
    Predictions carry the stored cluster ids.
    """
    points = scale(assemble(filter_box(raw, box, positive), id_column, columns), scaler)
    return assign_nearest(points, centroids).select(
        F.col("id").cast("string").alias("point_id"),
        "cluster_id",
        *[F.expr(f"features[{i}]").alias(n) for i, n in enumerate(names)],
    )
