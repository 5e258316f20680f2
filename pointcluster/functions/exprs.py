"""SQL expression builders shared by the operators.

Expressions are built as SQL text: one parse on the JVM instead of a chain of
py4j calls, and everything stays inside whole-stage code generation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Distances are unrolled into generated code up to these sizes. Above them the
# generated method outgrows what the JIT compiles and numpy blocks are faster.
UNROLL_MAX_CENTERS = 24
UNROLL_MAX_TERMS = 128


def unrolls(k: int, d: int) -> bool:
    return k <= UNROLL_MAX_CENTERS and k * d <= UNROLL_MAX_TERMS


def lit(value: float) -> str:
    """A double literal in SQL text."""
    value = float(value)
    if not math.isfinite(value):
        raise ValueError(f"not a finite number: {value}")
    return f"({value!r}D)"


def feature_names(d: int, prefix: str = "f") -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def dimension(points: DataFrame) -> int:
    """Number of features; from column metadata if present, else one row."""
    field = points.schema["features"]
    known = field.metadata.get("dimension")
    if known:
        return int(known)
    row = points.select(F.size("features").alias("d")).first()
    if row is None or row["d"] is None or row["d"] < 1:
        raise ValueError("no points")
    return int(row["d"])


def features_column(names: Sequence[str]):
    """``features`` array over scalar columns, with its width as metadata."""
    return F.array(*[F.col(n).cast("double") for n in names]).alias(
        "features", metadata={"dimension": len(names)}
    )


BAD_FEATURE = "null or NaN feature"


def checked(value: str) -> str:
    """``value``, or an error where it is null or NaN."""
    return f"IF({value} IS NULL OR isnan({value}), CAST(raise_error('{BAD_FEATURE}') AS DOUBLE), {value})"


def unpack(points: DataFrame, d: int, *keep: str) -> DataFrame:
    """``features`` array -> double columns f0..f{d-1}; ``keep`` come first.

    A null or NaN feature is an error, here and in ``feature_block``: no
    distance to it exists, whatever the number of centers.
    """
    return points.selectExpr(
        *keep, *[f"{checked(f'features[{i}]')} AS {n}" for i, n in enumerate(feature_names(d))]
    )


def feature_block(features: pd.Series, d: int) -> np.ndarray:
    """A batch of ``features`` as an array of (rows, d)."""
    if not len(features):
        return np.empty((0, d))
    if features.isna().any():
        raise ValueError(BAD_FEATURE)
    x = np.stack(features.to_numpy())[:, :d].astype(float)
    if np.isnan(x).any():
        raise ValueError(BAD_FEATURE)
    return x


def sq_dist(left: Sequence[str], right: Sequence[str]) -> str:
    """Squared Euclidean distance between two lists of scalar expressions."""
    return " + ".join(f"({a} - {b}) * ({a} - {b})" for a, b in zip(left, right))


def rounded(value: str, digits: int) -> str:
    """``round(value, digits)`` without a decimal per row: a scaled value below 10^6 that is
    clear of a half, whatever its last bits, is rounded as a number."""
    scale = lit(10.0**digits)
    scaled = f"({value} * {scale})"
    return (
        f"IF(abs({scaled}) < 1e6D AND abs({scaled} - floor({scaled}) - 0.5D) > 1e-6D, "
        f"floor({scaled} + 0.5D) / {scale}, round({value}, {digits}))"
    )


def sq_dist_to(names: Sequence[str], center: Sequence[float]) -> str:
    return sq_dist(names, [lit(v) for v in center])
