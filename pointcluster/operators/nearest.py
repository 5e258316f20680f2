"""Nearest centroid of each point.

Few centroids are unrolled into column arithmetic. Larger sets run as numpy
blocks over Arrow batches, very many through a kd tree over them. In each the centroids (k x d numbers) are part of
the plan, so points are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import feature_block, feature_names, sq_dist_to, unpack, unrolls
from .centerindex import CenterIndex

# From this many centers on a tree over them beats comparing with each (2 and 3 features).
INDEX_MIN_CENTERS = 2_000

CENTROID_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("centroid", T.ArrayType(T.DoubleType())),
    ]
)


def centroid_list(centroids: DataFrame) -> tuple[list[int], list[list[float]]]:
    """Ids and positions, sorted by id."""
    rows = sorted(centroids.select("cluster_id", "centroid").collect())
    if not rows:
        raise ValueError("no centroids")
    return [int(r[0]) for r in rows], [[float(v) for v in r[1]] for r in rows]


def centroid_frame(
    spark: SparkSession, centers: Sequence[Sequence[float]], ids: Sequence[int] | None = None
) -> DataFrame:
    ids = range(len(centers)) if ids is None else ids
    rows = [(int(j), [float(v) for v in c]) for j, c in zip(ids, centers)]
    return spark.createDataFrame(rows, CENTROID_SCHEMA)


def nearest_columns(df: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``c`` (index of the nearest center, least on ties) and ``d2``.

    ``df`` has the features as columns f0..f{d-1}. For unrolled sizes only.
    """
    names = feature_names(len(centers[0]))
    k = len(centers)
    distances = df.selectExpr(
        "*", *[f"{sq_dist_to(names, c)} AS _d{j}" for j, c in enumerate(centers)]
    )
    each = [f"_d{j}" for j in range(k)]
    least = each[0] if k == 1 else f"least({', '.join(each)})"
    pick = "CASE " + " ".join(f"WHEN _d{j} = d2 THEN {j}" for j in range(k - 1))
    pick = f"{pick} ELSE {k - 1} END" if k > 1 else "0"
    return distances.selectExpr(*df.columns, *each, f"{least} AS d2").selectExpr(
        *df.columns, f"{pick} AS c", "d2"
    )


def nearest_block(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest center for each row of x.

    One matrix product per strip of rows finds the centers that can be nearest;
    those within its rounding error are measured exactly, so ties and distances
    come out as by direct differences.
    """
    best = np.full(len(x), np.inf)
    index = np.zeros(len(x), dtype=np.int32)
    middle = centers.mean(axis=0)
    c = centers - middle
    norms = (c * c).sum(axis=1)
    strip = max(1, 4_000_000 // len(c))
    for at in range(0, len(x), strip):
        own = x[at : at + strip]
        y = own - middle
        size = (y * y).sum(axis=1)
        rough = norms - 2.0 * (y @ c.T)
        error = 1e-14 * x.shape[1] * (size + norms.max()) + 1e-300
        near = rough <= (rough.min(axis=1) + 2 * error)[:, None]
        rows, js = np.nonzero(near)
        exact = ((own[rows] - centers[js]) ** 2).sum(axis=1)
        order = np.lexsort((js, exact, rows))
        first = order[np.append(True, rows[order][1:] != rows[order][:-1])]
        best[at + rows[first]] = exact[first]
        index[at + rows[first]] = js[first]
    return index, best


def searcher(centers: np.ndarray):
    """``nearest_block`` for these centers, by an index from ``INDEX_MIN_CENTERS`` on."""
    if len(centers) >= INDEX_MIN_CENTERS:
        return CenterIndex(centers, nearest_block).nearest
    return lambda x: nearest_block(x, centers)


def assign_nearest(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """Points plus ``cluster_id`` (the stored id) and ``dist_sq``.

    The lowest index wins ties. Extra columns may have any name but these two, which are
    refused. A null or NaN feature is an error; repeated rows are rows of their own.
    """
    ids, centers = centroid_list(centroids)
    return assign_to_centers(points, centers, ids)


def assign_to_centers(
    points: DataFrame, centers: Sequence[Sequence[float]], ids: Sequence[int] | None = None
) -> DataFrame:
    """As ``assign_nearest`` for centers already on the driver."""
    k, d = len(centers), len(centers[0])
    ids = list(range(k)) if ids is None else list(ids)
    # the points' own columns travel in a struct, so none of them meets a name used here
    packed = points.select(F.struct("*").alias("_p"), "features")
    if unrolls(k, d):
        found = nearest_columns(unpack(packed, d, "_p"), centers)
        cluster = F.col("c")
        if ids != list(range(k)):
            cluster = F.expr(f"array({', '.join(map(str, ids))})[c]")
        found = found.select("_p", cluster.alias("cluster_id"), F.col("d2").alias("dist_sq"))
    else:
        table, known = np.array(centers, dtype=float), np.array(ids, dtype=np.int32)

        @F.pandas_udf("cluster_id int, dist_sq double")
        def nearest(features: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            search = searcher(table)
            for batch in features:
                index, d2 = search(feature_block(batch, d))
                yield pd.DataFrame({"cluster_id": known[index], "dist_sq": d2})

        found = packed.select("_p", nearest("features").alias("_n")).select(
            "_p", "_n.cluster_id", "_n.dist_sq"
        )
    taken = [c for c in points.columns if c.lower() in ("cluster_id", "dist_sq")]
    if taken:
        raise ValueError(f"points already have a column {taken[0]}")
    return found.select("_p.*", F.col("cluster_id").cast("int").alias("cluster_id"), "dist_sq")


def centroid_distances(centroids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pair distances ``(i, j, dist)`` and half gaps ``(i, half_gap)``.

    Only centroids are involved: k rows, k * k results. Every row meets the
    table of centers in a task; the k * k rows never pass through the driver.
    """
    ids, centers = centroid_list(centroids)
    spark = centroids.sparkSession
    table, known = np.array(centers, dtype=float), np.array(ids)
    rows = spark.range(0, len(ids), 1, max(1, min(len(ids) // 64, 1024)))

    def measure(batches):
        for batch in batches:
            for i in batch["id"]:
                dist = np.sqrt(((table - table[i]) ** 2).sum(axis=1))
                yield pd.DataFrame(
                    {"i": np.full(len(known), known[i], np.int32), "j": known.astype(np.int32), "dist": dist}
                )

    pairs = rows.mapInPandas(measure, "i int, j int, dist double")
    gaps = pairs.where("i <> j").groupBy("i").agg((F.min("dist") / 2).alias("half_gap"))
    return pairs, gaps


def distance_matrix(centers) -> np.ndarray:
    """k x k distances, a row at a time: memory k * (k + d)."""
    c = np.array(centers, dtype=float)
    return np.array([np.sqrt(((c - row) ** 2).sum(axis=1)) for row in c])


def half_gaps(matrix: np.ndarray) -> np.ndarray:
    """Half the distance from each center to its nearest other center."""
    others = matrix + np.diag(np.full(len(matrix), np.inf))
    return others.min(axis=1) / 2.0
