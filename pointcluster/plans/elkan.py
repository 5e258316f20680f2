"""Elkan K-Means: Lloyd's result with distances skipped by the triangle inequality.

Every point carries its cluster ``c``, an upper bound ``u`` on the distance to
that cluster's center and a lower bound ``l`` per center. A round

1. loosens the bounds by how far the centers moved,
2. leaves a point alone when ``u`` is at most half the gap around its center;
   otherwise tightens ``u`` once and computes only the distances to centers
   whose lower bound and half center distance both fall short of ``u``,
3. moves the point to a strictly closer center.

The state is materialised once per round and written down every few rounds.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durable import Workspace
from ..functions.exprs import BAD_FEATURE, dimension, feature_names, unpack
from ..operators.nearest import distance_matrix, half_gaps
from ..operators.sample import limit_points
from .kmeans import (
    KMeansResult,
    center_moves,
    check_options,
    starting_centers,
    moved,
    total_shift,
)

STORE_ROUNDS = 5
MAX_COLUMNS = 64


class BoundState:
    """One row per point: id, features, c, u, k lower bounds, n_dist.

    Rows advance in numpy over Arrow batches: which distances a point needs
    differs from row to row, and masked blocks compute only those. Features
    and bounds are plain double columns while they are few (cheap to cache and
    to hand over), arrays beyond that.
    """

    def __init__(self, points: DataFrame, k: int, d: int):
        self.k, self.d = k, d
        id_type = points.schema["id"].dataType.simpleString()
        if k + d <= MAX_COLUMNS:
            self.x, self.low = feature_names(d), feature_names(k, "l")
            kind = "double"
            self.start = unpack(points, d, "id")
        else:
            self.x, self.low = ["features"], ["l"]
            kind = "array<double>"
            self.start = points.select("id", "features")
        self.names = ["id", *self.x, "c", "u", *self.low, "n_dist"]
        self.schema = ", ".join(
            [f"id {id_type}"]
            + [f"{n} {kind}" for n in self.x]
            + ["c int", "u double"]
            + [f"{n} {kind}" for n in self.low]
            + ["n_dist long"]
        )

    def initial(self, centers) -> DataFrame:
        table = np.array(centers, dtype=float)
        x_names, names = self.x, self.names

        def start(batches):
            for batch in batches:
                x = _read(batch, x_names, table.shape[1])
                if np.isnan(x).any():
                    raise ValueError(BAD_FEATURE)
                low = np.empty((len(x), len(table)), order="F")
                for j, center in enumerate(table):
                    low[:, j] = _dist(x, center)
                c = low.argmin(axis=1)
                u = low[np.arange(len(x)), c]
                n_dist = np.full(len(x), len(table))
                yield _write(names, batch, x_names, c, u, low, n_dist)

        return self.start.mapInArrow(start, self.schema)

    def step(self, state: DataFrame, centers, moves) -> DataFrame:
        table = np.array(centers, dtype=float)
        matrix = distance_matrix(centers)
        halves, gaps = matrix / 2.0, half_gaps(matrix)
        moves = np.array(moves)
        x_names, low_names, names = self.x, self.low, self.names

        def advance(batches):
            k, d = table.shape
            for batch in batches:
                low = np.maximum(0.0, _read(batch, low_names, k) - moves)
                c = batch.column("c").to_numpy().astype(np.int64)
                u = batch.column("u").to_numpy() + moves[c]
                n_dist = np.zeros(len(c), dtype=np.int64)
                rows = np.flatnonzero(u > gaps[c])
                if len(rows):
                    x = _read(batch, x_names, d)
                    own = c[rows]
                    sub = low[rows]

                    def needed(bound):
                        open_to = (bound[:, None] > sub) & (bound[:, None] > halves[own])
                        open_to[np.arange(len(own)), own] = False
                        return open_to

                    opened = needed(u[rows]).any(axis=1)
                    rows, own, sub = rows[opened], own[opened], sub[opened]
                    u[rows] = _dist(x[rows], table[own])
                    low[rows, own] = u[rows]
                    tried = needed(u[rows])
                    for j in range(k):
                        at = rows[tried[:, j]]
                        dist = _dist(x[at], table[j])
                        low[at, j] = dist
                        closer = dist < u[at]
                        c[at[closer]] = j
                        u[at[closer]] = dist[closer]
                    n_dist[rows] = 1 + tried.sum(axis=1)
                yield _write(names, batch, x_names, c, u, low, n_dist)

        return state.mapInArrow(advance, self.schema)

    def means(self, state: DataFrame) -> tuple[dict, int]:
        """``{cluster: (count, mean)}`` and the number of distances."""
        if self.x == ["features"]:
            items = [f"features[{i}]" for i in range(self.d)]
        else:
            items = self.x
        rows = (
            state.groupBy("c")
            .agg(F.count("*"), F.sum("n_dist"), *[F.expr(f"avg({e})") for e in items])
            .collect()
        )
        return {r[0]: (r[1], list(r[3:])) for r in rows}, sum(r[2] for r in rows)

    def frame(self, state: DataFrame) -> DataFrame:
        if self.x == ["features"]:
            return state
        return state.select(
            "id",
            F.array(*self.x).alias("features", metadata={"dimension": self.d}),
            "c",
            "u",
            F.array(*self.low).alias("l"),
            "n_dist",
        )


def _dist(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - center) ** 2).sum(axis=1))


def _read(batch, names, width: int) -> np.ndarray:
    if len(names) == 1 and pa.types.is_list(batch.schema.field(names[0]).type):
        flat = batch.column(names[0]).flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, width)
    out = np.empty((batch.num_rows, width), order="F")
    for i, name in enumerate(names):
        out[:, i] = batch.column(name).to_numpy(zero_copy_only=False)
    return out


def _write(names, batch, x_names, c, u, low, n_dist):
    if x_names == ["features"]:
        offsets = np.arange(0, low.size + 1, low.shape[1], dtype=np.int32)
        bounds = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(low.ravel()))]
    else:
        bounds = [pa.array(low[:, j]) for j in range(low.shape[1])]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            *[batch.column(n) for n in x_names],
            pa.array(c.astype(np.int32)),
            pa.array(u),
            *bounds,
            pa.array(n_dist.astype(np.int64)),
        ],
        names=names,
    )


def _layout(points: DataFrame, k: int):
    return BoundState(points, k, dimension(points))


def elkan_init(points: DataFrame, centers: Sequence[Sequence[float]]) -> DataFrame:
    """Exact distances to all centers: ``(id, features, c, u, l, n_dist)``."""
    layout = _layout(points, len(centers))
    return layout.frame(layout.initial(centers))


def elkan_step(
    points: DataFrame,
    old: Sequence[Sequence[float]],
    new: Sequence[Sequence[float]],
) -> DataFrame:
    """The state after centers moved from ``old`` to ``new`` and one round."""
    layout = _layout(points, len(old))
    state = layout.step(layout.initial(old), new, center_moves(old, new))
    return layout.frame(state)


def elkan_kmeans(
    points: DataFrame,
    k: int = 5,
    max_iterations: int = 20,
    tol: float = 1e-4,
    seed: int = 42,
    limit: int | None = None,
    init: Sequence[Sequence[float]] | str | None = None,
    empty: str = "keep",
    shift_norm: str = "sum",
) -> KMeansResult:
    """Same arguments and centers as ``kmeans``.

    History counts the distances to points actually computed; the first round
    includes the k per point of the initial bounds.
    """
    check_options(empty, shift_norm, max_iterations)
    points = limit_points(points, limit)
    centers = starting_centers(points, k, seed, init)
    layout = _layout(points, len(centers))
    history, held, moves = [], None, None
    work = Workspace(points.sparkSession)
    try:
        for round_no in range(1, max_iterations + 1):
            started = time.perf_counter()
            state = layout.initial(centers) if held is None else layout.step(held, centers, moves)
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            means, n_dist = layout.means(state)
            if not means:
                raise ValueError("no points")
            if held is not None:
                held.unpersist()
            held = state
            if round_no % STORE_ROUNDS == 0 and round_no < max_iterations:
                cut = work.store(state)
                state.unpersist()
                held = cut
            new = moved(points, centers, means, empty, seed, round_no)
            moves = center_moves(centers, new)
            shift = total_shift(moves, shift_norm)
            previous, centers = centers, new
            history.append((round_no, shift, n_dist, time.perf_counter() - started))
            if shift < tol:
                break
    finally:
        if held is not None:
            held.unpersist()
        work.close()
    return KMeansResult(points, centers, previous, history)
