"""Nearest center among very many: a kd tree over the centers.

The centers are halved at the median of their widest feature until a leaf holds about
``LEAF`` of them; every node keeps the box around its centers. A point first goes down to the
leaf that lies nearest, which bounds its distance; then, from the root, only nodes are opened
whose box is not farther than that bound. All points of a batch go down together, as pairs
of (point, node). Results equal direct comparison with every center, the least index on ties.

Memory is bounded by ``PAIRS``: where a batch opens more pairs, its halves are searched one
after the other. Where boxes do not tell centers apart (many features without clusters),
points that open more than one in ``WIDE`` nodes of a level go through ``fallback`` instead,
which compares blocks of centers; the result is the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

LEAF = 16
WIDE = 16  # a node costs about as much as this many in blocks of centers
PAIRS = 500_000  # numbers in the pairs of one step


class CenterIndex:
    def __init__(self, centers: np.ndarray, fallback: Callable):
        self.centers, self.fallback = centers, fallback
        k, self.d = centers.shape
        self.depth = max(0, int(np.ceil(np.log2(max(k, 1) / LEAF))))
        runs = [np.arange(k)]
        for _ in range(self.depth):
            runs = [half for run in runs for half in self._halves(run)]
        self.order = np.concatenate(runs)
        self.ends = np.cumsum([len(run) for run in runs])
        starts = self.ends - [len(run) for run in runs]
        self.starts = starts
        ordered = centers[self.order]
        lo, hi = np.minimum.reduceat(ordered, starts), np.maximum.reduceat(ordered, starts)
        self.boxes = [(lo, hi)]
        for _ in range(self.depth):
            lo, hi = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2])
            self.boxes.insert(0, (lo, hi))

    def _halves(self, run: np.ndarray):
        c = self.centers[run]
        widest = int(np.argmax(c.max(axis=0) - c.min(axis=0)))
        order = run[np.argsort(c[:, widest], kind="stable")]
        return order[: len(run) // 2], order[len(run) // 2 :]

    def _to_box(self, x, level, points, nodes) -> np.ndarray:
        """Squared distance of each point to the box of each node."""
        lo, hi = self.boxes[level]
        own = x[points]
        gap = np.maximum(np.maximum(lo[nodes] - own, own - hi[nodes]), 0.0)
        return (gap * gap).sum(axis=1)

    def _best(self, x, points, leaves, index, best) -> None:
        """Compare with all centers of the leaves; ``points`` are in ascending order."""
        lengths = self.ends[leaves] - self.starts[leaves]
        shift = np.repeat(self.starts[leaves] - (np.cumsum(lengths) - lengths), lengths)
        js = self.order[shift + np.arange(len(shift))]
        rows = np.repeat(points, lengths)
        exact = ((x[rows] - self.centers[js]) ** 2).sum(axis=1)
        order = np.lexsort((js, exact, rows))
        first = order[np.append(True, rows[order][1:] != rows[order][:-1])]
        i, j, e = rows[first], js[first], exact[first]
        nearer = (e < best[i]) | ((e == best[i]) & (j < index[i]))
        index[i[nearer]], best[i[nearer]] = j[nearer], e[nearer]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest center for each row of x."""
        index, best = np.zeros(len(x), np.int32), np.full(len(x), np.inf)
        strip = max(1, PAIRS // (LEAF * self.d))
        for at in range(0, len(x), strip):
            part = slice(at, at + strip)
            index[part], best[part] = self._strip(x[part])
        return index, best

    def _strip(self, x):
        n = len(x)
        index, best = np.full(n, len(self.centers), np.int32), np.full(n, np.inf)
        every, node = np.arange(n), np.zeros(n, np.int64)
        for level in range(1, self.depth + 1):
            left, right = (self._to_box(x, level, every, 2 * node + side) for side in (0, 1))
            node = 2 * node + (right < left)
        self._best(x, every, node, index, best)
        self._open(x, every, np.zeros(n, np.int64), 0, node, index, best)
        return index, best

    def _open(self, x, points, nodes, level, seen, index, best) -> None:
        """Search below the nodes; ``seen`` are the leaves already compared."""
        while level < self.depth:
            if len(points) * self.d > PAIRS and points[0] != points[-1]:
                # halves by point, so that each has fewer pairs
                middle = points[len(points) // 2]
                cut = np.searchsorted(points, middle, "left" if points[0] < middle else "right")
                self._open(x, points[:cut], nodes[:cut], level, seen, index, best)
                self._open(x, points[cut:], nodes[cut:], level, seen, index, best)
                return
            level += 1
            points, nodes = np.repeat(points, 2), np.repeat(2 * nodes, 2)
            nodes[1::2] += 1
            # a trace above the bound: the box distance is rounded too
            near = self._to_box(x, level, points, nodes) <= best[points] * (1 + 1e-12) + 1e-300
            points, nodes = points[near], nodes[near]
            if 2**level >= WIDE * 4:
                lost = np.flatnonzero(np.bincount(points, minlength=len(x)) * WIDE > 2**level)
                if len(lost):
                    index[lost], best[lost] = self.fallback(x[lost], self.centers)
                    kept = ~np.isin(points, lost)
                    points, nodes = points[kept], nodes[kept]
            if not len(points):
                return
        new = nodes != seen[points]
        points, nodes = points[new], nodes[new]
        step = max(1, PAIRS // (LEAF * self.d))
        for at in range(0, len(points), step):
            self._best(x, points[at : at + step], nodes[at : at + step], index, best)
