"""Parallel seeding of K-Means: a few rounds of oversampling, then a weighted reclustering.

The first candidate is the first point in seeded order. In each round a point becomes
a candidate with a chance of ``oversample * k`` times its share of the squared
distances to the candidates so far, by a draw from md5(seed:round:id): the same points
on any partitioning, and in SQL. About ``oversample * k`` points a round reach the
driver. Every candidate then weighs as many points as it is nearest to. The start
takes the heaviest candidate, then again and again the one with the greatest weight
times squared distance to those taken (the earliest on ties), and moves them by weighted
means for ``RECLUSTER`` rounds. Where fewer than k candidates differ, points in seeded
order fill up.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.nearest import assign_to_centers
from ..operators.sample import seeded_sample

STEPS = 2
OVERSAMPLE = 2
RECLUSTER = 3


def draw(seed: int, round_no: int) -> Column:
    """A number in [0, 1) for each id."""
    text = F.concat(F.lit(f"{seed}:{round_no}:"), F.col("id").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / 2.0**52


def candidates(
    points: DataFrame, first: list[float], k: int, seed: int, steps: int, oversample: int
) -> tuple[list[list[float]], list[int]]:
    """Candidates in order of round and id, and the points nearest to each."""
    found = [first]
    for round_no in range(1, steps + 1):
        near = assign_to_centers(points.select("id", "features"), found)
        total = near.agg(F.sum("dist_sq")).first()[0]
        if not total:
            break
        hit = draw(seed, round_no) * total < oversample * k * F.col("dist_sq")
        rows = near.where(hit).select("id", "features").collect()
        found += [[float(v) for v in r["features"]] for r in sorted(rows, key=lambda r: r["id"])]
    near = assign_to_centers(points.select("id", "features"), found)
    counts = dict(near.groupBy("cluster_id").count().collect())
    return found, [counts.get(j, 0) for j in range(len(found))]


def reclustered(found: list[list[float]], weights: list[int], k: int) -> list[list[float]]:
    """At most k centers of weighted candidates; fewer where fewer candidates differ."""
    x, w = np.array(found, dtype=float), np.array(weights, dtype=float)

    def apart(center):
        return ((x - center) ** 2).sum(axis=1)

    taken = [int(np.argmax(w))]
    nearest = apart(x[taken[0]])
    while len(taken) < k:
        score = w * nearest
        best = int(np.argmax(score))
        if score[best] <= 0:
            break
        taken.append(best)
        nearest = np.minimum(nearest, apart(x[best]))
    centers = x[taken]
    for _ in range(RECLUSTER):
        index = np.stack([apart(c) for c in centers]).argmin(axis=0)
        for j in range(len(centers)):
            own = index == j
            if w[own].sum() > 0:
                centers[j] = (x[own] * w[own, None]).sum(axis=0) / w[own].sum()
    return centers.tolist()


def parallel_start(
    points: DataFrame, k: int, seed: int, steps: int = STEPS, oversample: int = OVERSAMPLE
) -> list[list[float]]:
    """k starting centers; ValueError if there are fewer points. Null features are an error."""
    from .kmeans import initial_centers

    first = initial_centers(points, 1, seed)[0]
    held = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = reclustered(*candidates(held, first, k, seed, steps, oversample), k)
        if len(centers) < k:
            if held.count() < k:
                raise ValueError(f"k = {k} exceeds the number of points")
            rest = [[float(v) for v in r["features"]] for r in seeded_sample(held, 2 * k, seed).collect()]
            fresh = [c for c in rest if c not in centers] + rest
            centers += fresh[: k - len(centers)]
        return centers
    finally:
        held.unpersist()
