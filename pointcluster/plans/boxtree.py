"""Lloyd K-Means over a tree of box summaries.

One pass sorts the points into leaf cells and sums them up: count, sums and bounding box per
leaf. Leaves are cut at quantiles of each feature (a mergeable sketch), so crowded places get
small cells, and numbered along a Z-order curve, so the boxes of a coarser level are those
of the finer one merged in groups of 2^d. At most 2^LEAF_BITS leaves exist whatever the
number of points: that is all that the driver holds and what a round broadcasts.

In each round boxes are tried from the root. A box that lies wholly on one center's side of
every bisector moves to that center as a whole, by its count and sums. A box that does not is
opened, for the centers that are still in question; the points of contested leaves, and only those, are compared with the centers, in
one job, as Lloyd does. A point goes to the same center as in ``plans.kmeans`` (boxes
within rounding of a bisector are contested, so ties are settled among points), and centers
agree up to the rounding of sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dimension, feature_names, unpack
from ..operators.sample import limit_points
from .kmeans import KMeansResult, check_options, cluster_means, run_rounds, starting_centers
from .roundlog import round_log

LEAF_BITS = 16


def bits_per_feature(d: int) -> int:
    """Levels of the tree; every level halves the cells of each feature."""
    if d > LEAF_BITS:
        raise ValueError(f"boxes are built for up to {LEAF_BITS} features; use kmeans")
    return min(8, LEAF_BITS // d)


def z_order(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Bits of the cell numbers interleaved, coarsest first."""
    code = np.zeros(len(cells[0]), np.int32)
    for bit in reversed(range(bits)):
        for c in cells:
            code = (code << 1) | ((c >> bit) & 1).astype(np.int32)
    return code


def with_leaves(features: DataFrame, d: int) -> DataFrame:
    """``f0..`` plus ``leaf``, the number of the point's cell."""
    names, bits = feature_names(d), bits_per_feature(d)
    side = 2**bits
    cuts = features.approxQuantile(names, [i / side for i in range(1, side)], 0.5 / side)
    if not all(cuts):
        raise ValueError("no points")
    edges = [np.array(c) for c in cuts]

    def place(batches):
        for batch in batches:
            cells = [np.searchsorted(e, batch[n].to_numpy(), "right") for n, e in zip(names, edges)]
            yield batch.assign(leaf=z_order(cells, bits))

    columns = ", ".join(f"{n} double" for n in names)
    return features.select(*names).mapInPandas(place, f"{columns}, leaf int")


class BoxTree:
    """Levels of ``(code, count, sums, lo, hi)``, from the root to the leaves."""

    def __init__(self, leaves: pd.DataFrame, d: int):
        names = feature_names(d)

        def part(kind):
            return leaves[[f"{kind}_{n}" for n in names]].to_numpy(dtype=float)

        level = (
            leaves["leaf"].to_numpy(), leaves["n"].to_numpy(), part("sum"), part("min"), part("max")
        )
        self.d, self.levels = d, [level]
        while len(level[0]) > 1 or level[0][0]:
            level = self._merged(*level)
            self.levels.insert(0, level)

    def _merged(self, code, count, sums, lo, hi):
        parent, first = np.unique(code >> self.d, return_index=True)
        return (
            parent, np.add.reduceat(count, first), np.add.reduceat(sums, first),
            np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first),
        )

    def settle(self, centers) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Counts and sums of owned boxes per center, contested leaves, distances taken.

        A box is tried with the centers its parent left open only: those that can be
        nearest to some point of it.
        """
        centers = np.array(centers, dtype=float)
        counts, sums = np.zeros(len(centers), np.int64), np.zeros(centers.shape)
        pairs = 0
        parents, lengths = np.array([0], np.int32), np.array([len(centers)])
        rivals = np.arange(len(centers))
        for code, n, s, lo, hi in self.levels:
            up = np.searchsorted(parents, code >> self.d)
            up[up == len(parents)] = 0
            at = np.flatnonzero(parents[up] == code >> self.d)
            up = up[at]
            rivals, lengths = _repeated(rivals, lengths, up)
            pairs += len(rivals)
            owner, open_ = _rivals(lo[at], hi[at], centers, rivals, lengths)
            left = np.add.reduceat(open_, np.cumsum(lengths) - lengths)
            held = left == 1  # the owner itself
            np.add.at(counts, owner[held], n[at][held])
            np.add.at(sums, owner[held], s[at][held])
            parents, rivals = code[at][~held], rivals[open_ & np.repeat(~held, lengths)]
            lengths = left[~held]
            if not len(parents):
                break
        return counts, sums, parents, pairs


def _repeated(values: np.ndarray, lengths: np.ndarray, take: np.ndarray):
    """Runs of ``values`` (of the given lengths), taken by number, and their lengths."""
    starts, lengths = (np.cumsum(lengths) - lengths)[take], lengths[take]
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return values[shift + np.arange(len(shift))], lengths


def _rivals(lo, hi, centers, rivals, lengths) -> tuple[np.ndarray, np.ndarray]:
    """The center nearest to each box's middle; which rivals may be nearest within the box.

    ``rivals`` holds the numbers of the centers of each box, box after box.
    """
    starts = np.cumsum(lengths) - lengths
    middle = np.repeat((lo + hi) / 2, lengths, axis=0)
    apart = ((middle - centers[rivals]) ** 2).sum(axis=1)
    order = np.lexsort((rivals, apart, np.repeat(np.arange(len(lo)), lengths)))
    owner = rivals[order[starts]]
    own, other = np.repeat(centers[owner], lengths, axis=0), centers[rivals]
    # the box's corner farthest towards the rival
    corner = np.where(other > own, np.repeat(hi, lengths, axis=0), np.repeat(lo, lengths, axis=0))
    near, far = ((corner - own) ** 2).sum(axis=1), ((corner - other) ** 2).sum(axis=1)
    size = (np.abs(corner) + np.abs(own) + np.abs(other)).max(axis=1) ** 2
    open_ = ~(far - near > 1e-13 * centers.shape[1] * size)
    open_[rivals == np.repeat(owner, lengths)] = True
    return owner, open_


def among(leaves: np.ndarray, d: int) -> str:
    """SQL: ``leaf`` is one of ``leaves``, by a bitmap of 2^LEAF_BITS bits at most."""
    words = np.zeros((1 << (d * bits_per_feature(d)) >> 5) + 1, np.int64)
    np.bitwise_or.at(words, leaves >> 5, np.int64(1) << (leaves & 31).astype(np.int64))
    bitmap = ", ".join(f"{w}L" for w in words.tolist())
    return f"(shiftright(array({bitmap})[shiftright(leaf, 5)], leaf & 31) & 1L) = 1L"


def summarize(features: DataFrame, d: int) -> BoxTree:
    """The tree of ``features`` with leaves (at most 2^LEAF_BITS rows reach the driver)."""
    aggregates = [F.count("*").alias("n")]
    for n in feature_names(d):
        aggregates += [f(n).alias(f"{f.__name__}_{n}") for f in (F.sum, F.min, F.max)]
    rows = features.groupBy("leaf").agg(*aggregates).toArrow().to_pandas()
    return BoxTree(rows.sort_values("leaf", ignore_index=True), d)


def tree_step(features: DataFrame, tree: BoxTree, centers) -> tuple[dict, int]:
    """One Lloyd step: ``{cluster: (count, mean)}`` and the distances taken."""
    counts, sums, contested, n_dist = tree.settle(centers)
    if len(contested):
        rows = features.where(among(contested, tree.d)).drop("leaf")
        for j, (n, mean) in cluster_means(rows, centers).items():
            counts[j] += n
            sums[j] += n * np.array(mean)
            n_dist += n * len(centers)
    means = {j: (int(n), (sums[j] / n).tolist()) for j, n in enumerate(counts) if n}
    return means, int(n_dist)


def tree_kmeans(
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
    """``kmeans`` by box summaries, for up to LEAF_BITS features; same arguments and result.

    Pays off with many centers or many rounds over many points: rounds then touch few of
    them. ``n_dist`` counts distances to boxes and to points of contested leaves. A null or
    NaN feature and an empty table are errors; repeated points are points of their own.
    """
    check_options(empty, shift_norm, max_iterations)
    points = limit_points(points, limit)
    d = dimension(points)
    bits_per_feature(d)
    log = round_log(points, resume, "boxes", k, seed, limit, init, empty, shift_norm)
    centers = log.start() if log is not None else None
    if centers is None:
        centers = starting_centers(points, k, seed, init)
    features = with_leaves(unpack(points, d), d).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tree = summarize(features, d)
        return run_rounds(
            points, centers, lambda c: tree_step(features, tree, c),
            max_iterations, tol, seed, empty, shift_norm, log,
        )
    finally:
        features.unpersist()
