"""Lloyd K-Means on DataFrames.

One job per round: nearest centroid as column arithmetic, partial sums per
partition, k rows through the shuffle and to the driver. Every round starts
from the same stored features, so lineage does not grow.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..functions.exprs import BAD_FEATURE, dimension, feature_names, unpack, unrolls
from ..operators.nearest import (
    assign_to_centers,
    centroid_frame,
    nearest_columns,
    searcher,
)
from ..operators.sample import limit_points, seeded_sample
from .roundlog import RoundLog, round_log
from .seeding import parallel_start

HISTORY_SCHEMA = "iter int, shift double, n_dist long, seconds double"


@dataclass
class KMeansResult:
    """Centers after the last update and one history row per round."""

    points: DataFrame
    centers: list[list[float]]
    label_centers: list[list[float]]
    history_rows: list[tuple] = field(default_factory=list)

    @property
    def centroids(self) -> DataFrame:
        return centroid_frame(self.points.sparkSession, self.centers)

    @property
    def history(self) -> DataFrame:
        """``(iter, shift, n_dist, seconds)``."""
        return self.points.sparkSession.createDataFrame(self.history_rows, HISTORY_SCHEMA)

    def assign(self) -> DataFrame:
        """Points with the nearest of the returned centers."""
        return assign_to_centers(self.points, self.centers)

    def labels(self) -> DataFrame:
        """Points with the labels of the last round (before its update)."""
        return assign_to_centers(self.points, self.label_centers)

    def inertia(self) -> DataFrame:
        """Squared distance of last-round labels to the returned centers."""
        from ..operators.evaluate import inertia

        return inertia(self.labels().drop("dist_sq"), self.centroids)


def initial_centers(points: DataFrame, k: int, seed: int) -> list[list[float]]:
    """k distinct points in seeded order; ValueError if there are fewer."""
    if k <= 0:
        raise ValueError("k must be a positive integer")
    rows = seeded_sample(points, k, seed).collect()
    if len(rows) < k:
        raise ValueError(f"k = {k} exceeds the number of points ({len(rows)})")
    from hashlib import md5

    rows.sort(key=lambda r: (md5(f"{seed}:{r['id']}".encode()).hexdigest(), r["id"]))
    if any(r["features"] is None or None in r["features"] for r in rows):
        raise ValueError(BAD_FEATURE)
    centers = [[float(v) for v in r["features"]] for r in rows]
    if np.isnan(centers).any():
        raise ValueError(BAD_FEATURE)
    return centers


def starting_centers(points: DataFrame, k: int, seed: int, init) -> list[list[float]]:
    """``init`` is None (k seeded points), 'k-means||' or the centers themselves."""
    if init is None:
        return initial_centers(points, k, seed)
    if isinstance(init, str):
        if init != "k-means||":
            raise ValueError("init must be 'k-means||' or a list of centers")
        return parallel_start(points, k, seed)
    return [list(map(float, c)) for c in init]


def cluster_means(features: DataFrame, centers: Sequence[Sequence[float]]) -> dict:
    """One Lloyd step: ``{cluster: (count, mean)}`` for non-empty clusters."""
    k, d = len(centers), len(centers[0])
    names = feature_names(d)
    if unrolls(k, d):
        sums = (
            nearest_columns(features, centers)
            .groupBy("c")
            .agg({"c": "count", **{n: "avg" for n in names}})
            .select("c", "count(c)", *[f"`avg({n})`" for n in names])
        )
        return {r[0]: (r[1], list(r[2:])) for r in sums.collect()}
    table = np.array(centers, dtype=float)

    def partial_sums(batches):
        totals, counts = np.zeros((k, d)), np.zeros(k, dtype=np.int64)
        search = searcher(table)
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            index, _ = search(x)
            counts += np.bincount(index, minlength=k)
            for i in range(d):
                totals[:, i] += np.bincount(index, weights=x[:, i], minlength=k)
        used = np.flatnonzero(counts)
        yield pd.DataFrame(
            {
                "c": np.repeat(used, d).astype(np.int32),
                "i": np.tile(np.arange(d), len(used)).astype(np.int32),
                "n": np.repeat(counts[used], d),
                "s": totals[used].ravel(),
            }
        )

    rows = (
        features.select(*names)
        .mapInPandas(partial_sums, "c int, i int, n long, s double")
        .groupBy("c", "i")
        .agg({"n": "sum", "s": "sum"})
        .select("c", "i", "sum(n)", "sum(s)")
        .collect()
    )
    means: dict = {}
    for c, i, n, s in rows:
        means.setdefault(c, (n, [0.0] * d))[1][i] = s / n
    return means


def moved(
    points: DataFrame,
    centers: list[list[float]],
    means: dict,
    empty: str,
    seed: int,
    round_no: int,
) -> list[list[float]]:
    """The next centers; an empty cluster keeps its place or is reseeded."""
    new = [means[j][1] if j in means else c for j, c in enumerate(centers)]
    lost = [j for j in range(len(centers)) if j not in means]
    if lost and empty == "reseed":
        fresh = initial_centers(points, len(lost), seed + round_no)
        for j, c in zip(lost, fresh):
            new[j] = c
    return new


def center_moves(old, new) -> np.ndarray:
    return np.sqrt(((np.array(new) - np.array(old)) ** 2).sum(axis=1))


def total_shift(moves: np.ndarray, shift_norm: str) -> float:
    return float(moves.sum() if shift_norm == "sum" else np.sqrt((moves**2).sum()))


def check_options(empty: str, shift_norm: str, max_iterations: int) -> None:
    if empty not in ("keep", "reseed"):
        raise ValueError("empty must be 'keep' or 'reseed'")
    if shift_norm not in ("sum", "l2"):
        raise ValueError("shift_norm must be 'sum' or 'l2'")
    if max_iterations <= 0:
        raise ValueError("max_iterations must be a positive integer")


def run_rounds(
    points: DataFrame,
    centers: list[list[float]],
    step: Callable[[list[list[float]]], tuple[dict, int]],
    max_iterations: int,
    tol: float,
    seed: int,
    empty: str,
    shift_norm: str,
    log: RoundLog | None = None,
) -> KMeansResult:
    """Rounds of ``step`` (centers -> means and distances taken) until the shift is below ``tol``.

    With a ``log`` every round is committed before the next one starts, and rounds found
    there are not run again.
    """
    previous, history = centers, []
    if log is not None:
        centers, previous, history = log.open(centers)
    while len(history) < max_iterations and not (history and history[-1][1] < tol):
        round_no = len(history) + 1
        started = time.perf_counter()
        means, n_dist = step(centers)
        if not means:
            raise ValueError("no points")
        new = moved(points, centers, means, empty, seed, round_no)
        shift = total_shift(center_moves(centers, new), shift_norm)
        previous, centers = centers, new
        history.append((round_no, shift, n_dist, time.perf_counter() - started))
        if log is not None:
            log.commit(history[-1], centers)
    return KMeansResult(points, centers, previous, history)


def kmeans(
    points: DataFrame,
    k: int = 5,
    max_iterations: int = 20,
    tol: float = 1e-4,
    seed: int = 42,
    limit: int | None = None,
    init: Sequence[Sequence[float]] | str | None = None,
    empty: str = "keep",
    shift_norm: str = "sum",
    resume: str | None = None,
) -> KMeansResult:
    """Lloyd K-Means; stops when the shift falls below ``tol``.

    ``shift_norm`` 'sum' adds up the centroid moves, 'l2' is the Frobenius
    norm. ``init`` replaces the seeded choice of k points: 'k-means||' (``plans.seeding``)
    or a list of centers. ``resume`` names a shared folder (``plans.roundlog``) where rounds
    are committed: a restarted driver goes on after the last one.
    """
    check_options(empty, shift_norm, max_iterations)
    points = limit_points(points, limit)
    log = round_log(points, resume, "lloyd", k, seed, limit, init, empty, shift_norm)
    centers = log.start() if log is not None else None
    if centers is None:
        centers = starting_centers(points, k, seed, init)
    features = unpack(points, dimension(points)).persist(StorageLevel.MEMORY_AND_DISK)

    def step(centers):
        means = cluster_means(features, centers)
        return means, sum(n for n, _ in means.values()) * len(centers)

    try:
        return run_rounds(points, centers, step, max_iterations, tol, seed, empty, shift_norm, log)
    finally:
        features.unpersist()
