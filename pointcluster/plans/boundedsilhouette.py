"""Euclidean silhouette of all rows, with an error bound, in time linear in the rows.

One aggregate sums up every cluster's points in leaf cells of a space-filling curve: count n,
mean m and scatter S (the summed squared distances to the mean). Coarser boxes are merged
from them on the driver, in groups of 2^d. For a point x and a box with u = |x - m|,

    n u  <=  sum |x - p|  <=  n u + min(S / 2u, sqrt(n S)),

from below as distances are convex, from above by sqrt(u^2 + t) <= u + t / 2u and by
Cauchy-Schwarz. So a far box enters as its moments, and its part of the error is known. Every
point walks the boxes of all clusters from the roots; a box whose upper and lower sums differ by
more than ``tolerance`` of the lower one is opened. Leaves are not opened: they enter with
their bound, which is nothing where all their points coincide (a table with fewer points
than cells is thus summed exactly, up to such ties). Bounds of all sums give bounds of a and b,
and as (b - a) / max(a, b) falls with a and grows with b, of the silhouette.

The leaves held and broadcast number at most about ``LEAVES`` whatever the rows. Points meet
no other points, so they are shuffled only to spread a table of few splits over the cores.
Rows are sorted by place within their task, and those of a cell walk together: boxes that all
of them open, or none, are told from the box around the rows; the rest are met row by row. What
a row meets is what it would meet alone. A task holds a batch and a bounded number of pairs.

Defined results: rows with a null label take no part; a null or NaN feature is an error;
the only point of its cluster scores 0, and so does a point with a = b = 0; repeated rows
count as often as they come; fewer than two labels (or no rows) give NaN.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.curve import quantile_cuts, with_place
from ..functions.durable import workers_find_package
from ..functions.exprs import dimension, feature_names, unpack

LEAVES = 1 << 18
MAX_SLICE_BITS = 9
PAIRS = 2_000_000  # of a point and a box, at a time
TILE = 1 << 15  # of them in arrays that fit a core's cache
STRIP = 2_048
TOGETHER = 256  # rows of a cell that is not cut finer
TASK_ROWS = 10_000  # worth a task of their own while cores are idle
DENSE_ROWS = 100_000  # otherwise: the more rows a task has, the nearer are neighbours


class MomentTree:
    """Boxes of all clusters by level: count, mean, scatter and where the children are.

    ``cluster`` numbers clusters from 0; rows of every level are sorted by (cluster, code).
    """

    def __init__(self, cluster, code, count, mean, scatter, d: int, bits: int):
        order = np.lexsort((code, cluster))
        level = tuple(np.asarray(v)[order] for v in (cluster, code, count, mean, scatter))
        self.sizes = np.bincount(level[0], weights=level[2])
        levels = [level]
        for _ in range(bits):
            levels.insert(0, _merged(*levels[0], d))
        self.levels = []
        for i, (cluster, code, count, mean, scatter) in enumerate(levels):
            first = lengths = None
            if i + 1 < len(levels):
                # children of a box are neighbours in the next level
                up = np.stack([levels[i + 1][0], levels[i + 1][1] >> d])
                starts = np.flatnonzero(np.r_[True, np.any(up[:, 1:] != up[:, :-1], axis=0)])
                first, lengths = starts, np.diff(np.r_[starts, up.shape[1]])
            self.levels.append((cluster, count.astype(float), mean, scatter, first, lengths))

    def sums(self, x: np.ndarray, tolerance: float):
        """Lower bounds and gaps of the summed distances from every row of ``x`` to every
        cluster, both (rows, clusters), and the number of boxes met.

        The rows walk together while the box around them tells that all of them open a box
        or none does; only where it can't tell, a row and a box are met one by one."""
        k = len(self.sizes)
        lower, gap = np.zeros(len(x) * k), np.zeros(len(x) * k)
        least, most = x.min(axis=0), x.max(axis=0)
        shared, whole = np.arange(len(self.levels[0][0])), []
        row = box = np.zeros(0, np.int64)
        met = 0
        for cluster, count, mean, scatter, first, lengths in self.levels:
            met += len(shared) * len(x)
            n, s = count[shared], scatter[shared]
            if first is None:
                opens = np.zeros(len(shared), bool)
            else:
                below, above = least - mean[shared], mean[shared] - most
                near = np.sqrt((np.maximum(np.maximum(below, above), 0.0) ** 2).sum(axis=1))
                far = np.sqrt((np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1))
                opens = _over(far, n, s) > tolerance * n * far
                unsure = ~opens & (_over(near, n, s) > tolerance * n * near)
                row = np.concatenate([row, np.repeat(np.arange(len(x)), unsure.sum())])
                box = np.concatenate([box, np.tile(shared[unsure], len(x))])
                met -= int(unsure.sum()) * len(x)
                n, s, shared, opens = (v[~unsure] for v in (n, s, shared, opens))
            taken = shared[~opens]
            whole.append((cluster[taken], mean[taken], n[~opens], s[~opens]))
            if len(row) > PAIRS and len(x) > 1:
                half = len(x) // 2
                a, b = self.sums(x[:half], tolerance), self.sums(x[half:], tolerance)
                return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), a[2] + b[2]
            met += len(row)
            open_ = self._one_by_one(
                x, row, box, (cluster, count, mean, scatter, first), tolerance, lower, gap
            )
            if first is None:
                break
            row, box = row[open_], box[open_]
            times, shared = lengths[box], shared[opens]
            row, box = np.repeat(row, times), _children(first, lengths, box)
            shared = _children(first, lengths, shared)
            if not len(row) and not len(shared):
                break
        lower, gap = lower.reshape(-1, k), gap.reshape(-1, k)
        _add_whole(x, [np.concatenate(v) for v in zip(*whole)], lower, gap)
        return lower, gap, met

    @staticmethod
    def _one_by_one(x, row, box, level, tolerance: float, lower, gap):
        """Adds the boxes that their rows take as they are; returns which others are opened."""
        cluster, count, mean, scatter, first = level
        k = len(lower) // len(x)
        u2 = np.zeros(len(row))
        for i in range(x.shape[1]):
            u2 += (x[row, i] - mean[box, i]) ** 2
        u, n = np.sqrt(u2), count[box]
        low, over = n * u, _over(u, n, scatter[box])
        open_ = over > tolerance * low if first is not None else np.zeros(len(row), bool)
        if not open_.all():
            at = row[~open_] * k + cluster[box[~open_]]
            lower += np.bincount(at, low[~open_], len(lower))
            gap += np.bincount(at, over[~open_], len(gap))
        return open_

    def silhouettes(self, x: np.ndarray, own: np.ndarray, tolerance: float):
        """Least and largest possible silhouette of every row, and the boxes met."""
        lower, gap, met = self.sums(x, tolerance)
        upper = lower + gap
        rows = np.arange(len(x))
        n = self.sizes[own]
        others = np.maximum(n - 1, 1)
        a_low, a_high = lower[rows, own] / others, upper[rows, own] / others
        lower, upper = lower / self.sizes, upper / self.sizes
        lower[rows, own] = upper[rows, own] = np.inf
        b_low, b_high = lower.min(axis=1), upper.min(axis=1)
        alone = n == 1
        low = np.where(alone, 0.0, _silhouette(a_high, b_low))
        high = np.where(alone, 0.0, _silhouette(a_low, b_high))
        return low, high, met


def _silhouette(a, b):
    most = np.maximum(a, b)
    return np.where(most > 0, (b - a) / np.where(most > 0, most, 1.0), 0.0)


def _over(u, n, s):
    """How much more than ``n u`` the summed distances to a box can be."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        return np.fmin(s / (2 * u), np.sqrt(n * s))


def _children(first, lengths, box):
    """The children of every box, one box after the other."""
    times = lengths[box]
    ends = np.cumsum(times)
    inner = np.arange(times.sum()) - np.repeat(ends - times, times)
    return np.repeat(first[box], times) + inner


def _add_whole(x, boxes, lower, gap) -> None:
    """Adds boxes that all rows of ``x`` take, few enough pairs at a time for the caches."""
    if not len(boxes[0]):
        return
    order = np.argsort(boxes[0], kind="stable")
    cluster, mean, n, s = (v[order] for v in boxes)
    starts = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
    half, cap = s / 2, np.sqrt(n * s)
    rows = max(1, TILE // len(n))
    for at in range(0, len(x), rows):
        part = x[at : at + rows]
        u = np.zeros((len(part), len(n)))
        for i in range(x.shape[1]):
            step = part[:, i, None] - mean[:, i]
            step *= step
            u += step
        np.sqrt(u, out=u)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            over = np.divide(half, u)
            np.fmin(over, cap, out=over)
        u *= n
        lower[at : at + rows, cluster[starts]] += np.add.reduceat(u, starts, axis=1)
        gap[at : at + rows, cluster[starts]] += np.add.reduceat(over, starts, axis=1)


def near_rows(place: np.ndarray, d: int, bits: int):
    """Slices of rows sorted by ``place`` that walk together: those of one cell of the curve,
    cut finer while a cell has more than ``TOGETHER`` of them, at most ``STRIP``."""
    todo = [(0, len(place), bits)]
    while todo:
        lo, hi, level = todo.pop()
        if hi - lo <= TOGETHER or not level:
            yield from (slice(at, min(at + STRIP, hi)) for at in range(lo, hi, STRIP))
            continue
        cell = place[lo:hi] >> (d * (level - 1))
        cuts = [lo, *(np.flatnonzero(cell[1:] != cell[:-1]) + lo + 1).tolist(), hi]
        todo += [(a, b, level - 1) for a, b in zip(cuts[:-1], cuts[1:])]


def _merged(cluster, code, count, mean, scatter, d: int):
    """The level above: moments of boxes with one parent, added without cancellation."""
    up = code >> d
    first = np.flatnonzero(np.r_[True, (cluster[1:] != cluster[:-1]) | (up[1:] != up[:-1])])
    lengths = np.diff(np.r_[first, len(code)])
    n = np.add.reduceat(count, first)
    center = np.add.reduceat(mean * count[:, None], first) / n[:, None]
    apart = ((mean - np.repeat(center, lengths, axis=0)) ** 2).sum(axis=1)
    return cluster[first], up[first], n, center, np.add.reduceat(scatter + count * apart, first)


def slice_bits(d: int, k: int) -> int:
    """Halvings of every feature, so that k clusters have at most ``LEAVES`` leaves; 0 where
    even one is too many (then clusters enter whole, with a wide bound)."""
    if k > LEAVES:
        raise ValueError(f"more than {LEAVES} clusters: take silhouette_euclid, by a sample")
    return min(MAX_SLICE_BITS, int(math.log2(LEAVES / k)) // d)


def silhouette_bounds(labelled: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """``labelled (id, features, cluster_id)`` -> ``(id, cluster_id, sil_low, sil_high)``.

    The exact silhouette of every row, among all rows, lies between the two (up to rounding).
    Work a point grows with the clusters and, in the plane, with 1 / tolerance.
    """
    return _scored(labelled, tolerance, ["id"]).select("id", "cluster_id", "sil_low", "sil_high")


def silhouette_euclid_all(
    labelled: DataFrame, algorithm: str, tolerance: float = 0.005
) -> DataFrame:
    """Mean Euclidean silhouette of all rows.

    One row ``(algorithm, k, n_points, silhouette_score, error_bound, n_boxes)``: the exact
    mean differs from ``silhouette_score`` by at most ``error_bound`` (up to rounding);
    ``n_boxes`` counts the distances taken to box means.
    """
    spark = labelled.sparkSession
    form = (
        "algorithm string, k int, n_points long, silhouette_score double, error_bound double, "
        "n_boxes long"
    )
    found = _scored(labelled, tolerance, [])
    if isinstance(found, tuple):
        return spark.createDataFrame([(algorithm, *found, math.nan, math.nan, 0)], form)
    row = found.agg(
        F.countDistinct("cluster_id").cast("int").alias("k"), F.count("*").alias("n"),
        F.avg((F.col("sil_low") + F.col("sil_high")) / 2).alias("score"),
        F.avg((F.col("sil_high") - F.col("sil_low")) / 2).alias("bound"),
        F.sum("boxes").alias("boxes"),
    ).first()
    return spark.createDataFrame([(algorithm, *row)], form)


def _scored(labelled: DataFrame, tolerance: float, keep: list[str]):
    """Rows with their bounds; (labels, rows) alone if there are fewer than two labels and
    no ``keep`` asks for rows."""
    if tolerance <= 0:
        raise ValueError("tolerance must be positive")
    spark = labelled.sparkSession
    workers_find_package(spark)
    labelled = labelled.where("cluster_id IS NOT NULL")
    counts = labelled.agg(F.countDistinct("cluster_id"), F.count("*")).first()
    if counts[0] < 2:
        if not keep:
            return tuple(counts)
        nan = F.lit(math.nan)
        return labelled.withColumns({"sil_low": nan, "sil_high": nan})
    d = dimension(labelled)
    names, bits = feature_names(d), slice_bits(d, counts[0])
    flat = unpack(labelled, d, "cluster_id", *keep)
    _, cuts = quantile_cuts(flat, names, bits)
    leaves = (
        with_place(flat, names, cuts, "_leaf")
        .groupBy("cluster_id", "_leaf")
        .agg(
            F.count("*").alias("n"),
            *[F.avg(c).alias(f"m_{c}") for c in names],
            *[(F.var_pop(c) * F.count("*")).alias(f"s_{c}") for c in names],
        )
        .toPandas()  # at most about LEAVES rows
    )
    codes, labels = pd.factorize(leaves["cluster_id"], sort=True)
    tree = MomentTree(
        codes, leaves["_leaf"].to_numpy(), leaves["n"].to_numpy(),
        leaves[[f"m_{c}" for c in names]].to_numpy(dtype=float),
        leaves[[f"s_{c}" for c in names]].to_numpy(dtype=float).sum(axis=1), d, bits,
    )
    held = spark.sparkContext.broadcast((tree, {v: i for i, v in enumerate(labels.tolist())}))

    def score(batches):
        tree, place = held.value
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            own = np.array([place[v] for v in batch["cluster_id"].tolist()], int)
            low, high = np.zeros(len(x)), np.zeros(len(x))
            boxes = np.zeros(len(x), np.int64)
            for part in near_rows(batch["_leaf"].to_numpy(), d, bits):
                low[part], high[part], boxes[part.start] = tree.silhouettes(
                    x[part], own[part], tolerance
                )  # a group's boxes, at its first row
            yield batch.drop(columns=[*names, "_leaf"]).assign(
                sil_low=low, sil_high=high, boxes=boxes
            )

    kept = [f for f in flat.schema if f.name not in names]
    out = T.StructType([
        *kept, *[T.StructField(c, T.DoubleType()) for c in ("sil_low", "sil_high")],
        T.StructField("boxes", T.LongType()),
    ])
    cores = spark.sparkContext.defaultParallelism
    rounds = min(8, -(-counts[1] // (cores * DENSE_ROWS)))
    wanted = min(cores * rounds, -(-counts[1] // TASK_ROWS))
    if flat.rdd.getNumPartitions() < wanted:
        flat = flat.repartition(wanted)
    placed = with_place(flat.select(*[f.name for f in kept], *names), names, cuts, "_leaf")
    return placed.sortWithinPartitions("_leaf").mapInPandas(score, out)
