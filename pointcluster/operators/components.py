"""Connected components: spanning forests in tasks, then repeated contraction.

First every task unites the ends of its own edges and keeps a star per component it
sees: fewer rows than it has nodes, whatever the number of edges. Up to ``LOCAL_ROWS``
such rows are finished by one task; beyond, contraction rounds shrink the graph and each
round's edges become forests again. Each round every node points to the node of least random priority at most two
steps away, follows that pointer once more, and the graph is rebuilt on the
nodes pointed to. Most nodes vanish per round whatever the shape of the graph
or the order of its ids: chains and stars alike take O(log n) rounds on ever
smaller edge sets. Unwinding the rounds then hands the component's least id
back to every node.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durable import Workspace, stored
from .joins import BROADCAST_ROWS, balanced_join


LOCAL_ROWS = 1_000_000
HELD_ROWS = 500_000


@dataclass
class Components:
    labels: DataFrame
    rounds: int
    most: int = 0  # an upper bound of the rows of labels


def connected_components(
    edges: DataFrame, work: Workspace | None = None, max_rounds: int = 200
) -> Components:
    """``(src, dst)`` -> ``labels (id, comp)``: each node's least connected id.

    Direction does not matter, nor do repeated edges. Nodes are all ids that occur: a
    self loop or an edge with a null end makes an isolated node known; an edge of two
    nulls says nothing. No edges give no labels.
    """
    own = work is None
    work = Workspace(edges.sparkSession) if own else work
    try:
        forest = work.store(spanning_forest(edges))
        n_rows = forest.count()
        if n_rows <= LOCAL_ROWS:
            labels = _finish(forest)
            return Components(stored(labels) if own else work.store(labels), 0, n_rows)
        links = _both_ways(forest, work)
        steps: list[tuple[DataFrame, int]] = []
        while n_links := links.count():
            if len(steps) >= max_rounds:
                raise RuntimeError(f"no end after {max_rounds} rounds")
            if n_links <= LOCAL_ROWS:
                labels = _finish(links).withColumnRenamed("comp", "parent")
                steps.append((work.store(labels), n_links))
                break
            # every node has a link, so there are at most n_links of them
            parents = _parents(links, n_links, len(steps), work)
            steps.append((parents, n_links))
            links = _contract(links, parents, n_links, work)
        alone = forest.where("src = dst").selectExpr("src AS id").distinct()
        if steps:
            labels = _unwind(steps, work)
            alone = alone.join(labels.select("id"), "id", "left_anti")
            labels = labels.unionByName(alone.selectExpr("id", "id AS comp"))
        else:
            labels = alone.selectExpr("id", "id AS comp")
        return Components(stored(labels) if own else labels, len(steps), n_rows)
    finally:
        if own:
            work.close()


# -- forests ---------------------------------------------------------------------


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least connected node of each of the nodes 0..n-1 under the edges ``a``-``b``.

    At least one end of every live edge hooks onto a smaller root, so the roots that
    still have edges halve per round.
    """
    label = np.arange(n)
    while len(a):
        ends = label[a], label[b]
        live = ends[0] != ends[1]
        a, b = a[live], b[live]
        low, high = np.minimum(*ends)[live], np.maximum(*ends)[live]
        np.minimum.at(label, high, low)
        while True:
            onward = label[label]
            if np.array_equal(onward, label):
                break
            label = onward
    return label


def _stars(src, dst):
    """``(nodes, least)``: each distinct end, and the least node of its component."""
    ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    return ids, ids[least_labels(len(ids), at[: len(src)], at[len(src) :])]


def _ends(batch: pa.RecordBatch):
    """Both ends as numpy arrays; a null end is the other one, two nulls are left out."""
    src, dst = batch.column(0), batch.column(1)
    known = pa.compute.coalesce(src, dst), pa.compute.coalesce(dst, src)
    if known[0].null_count:
        keep = pa.compute.is_valid(known[0])
        known = [k.filter(keep) for k in known]
    return [k.to_numpy(zero_copy_only=False) for k in known]


def _united(batches: Iterator[pa.RecordBatch], names: list[str], all_rows: bool):
    """Stars over the edges of a task; written out and begun anew beyond ``HELD_ROWS`` nodes
    (``all_rows``: held to the end)."""
    held, rows, kind = [], 0, None

    def folded():
        nodes, least = _stars(*[np.concatenate([h[i] for h in held]) for i in (0, 1)])
        return [(nodes, least)], len(nodes)

    def out(nodes, least):
        for lo in range(0, len(nodes), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[part], kind) for v in (nodes, least)], names=names
            )

    for batch in batches:
        kind = batch.schema[0].type
        held.append(_ends(batch))
        rows += batch.num_rows
        if rows > 2 * HELD_ROWS:
            held, rows = folded()
            if rows > HELD_ROWS and not all_rows:
                yield from out(*held[0])
                held, rows = [], 0
            elif rows > HELD_ROWS:
                rows = 0  # nodes are held; fold again after as many new edges
    if held:
        yield from out(*folded()[0][0])


def spanning_forest(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` with the components of ``edges`` and fewer rows than nodes per task; a
    node that a task sees without a smaller partner stands as ``(node, node)``."""
    edges = edges.select("src", "dst")
    kind = edges.schema["src"].dataType.simpleString()

    def run(batches):
        yield from _united(batches, ["src", "dst"], False)

    return edges.mapInArrow(run, f"src {kind}, dst {kind}")


def _finish(forest: DataFrame) -> DataFrame:
    """``(id, comp)`` of a forest of at most ``LOCAL_ROWS`` rows, in one task."""
    kind = forest.schema["src"].dataType.simpleString()

    def run(batches):
        yield from _united(batches, ["id", "comp"], True)

    return forest.coalesce(1).mapInArrow(run, f"id {kind}, comp {kind}")


def _both_ways(edges: DataFrame, work: Workspace) -> DataFrame:
    plain = edges.where("src <> dst")
    return work.store(plain.union(plain.select("dst", "src")).distinct())


def _parents(links: DataFrame, n_links: int, round_no: int, work: Workspace) -> DataFrame:
    """``(id, parent)`` for every node with a link."""
    large = n_links > BROADCAST_ROWS
    best = links.groupBy(F.col("src").alias("id")).agg(
        F.expr(f"min(xxhash64(dst, {round_no}))").alias("h"),
        F.expr(f"min_by(dst, xxhash64(dst, {round_no}))").alias("best"),
    )
    near = best.selectExpr("id", f"IF(h < xxhash64(id, {round_no}), best, id) AS near")
    near = work.store(near) if large else near
    # the least of the neighbours' choices is the least within two steps
    onward = near.select(F.col("id").alias("dst"), "near")
    pointers = (
        balanced_join(links, onward, ["dst"], n_links)
        .groupBy(F.col("src").alias("id"))
        .agg(F.expr(f"min_by(near, xxhash64(near, {round_no}))").alias("parent"))
    )
    pointers = work.store(pointers) if large else pointers
    onward = pointers.select(F.col("id").alias("parent"), F.col("parent").alias("next"))
    jumped = balanced_join(pointers, onward, ["parent"], n_links)
    return work.store(jumped.select("id", F.col("next").alias("parent")))


def _contract(links: DataFrame, parents: DataFrame, n_parents: int, work: Workspace):
    as_src = parents.select(F.col("id").alias("src"), F.col("parent").alias("new_src"))
    as_dst = parents.select(F.col("id").alias("dst"), F.col("parent").alias("new_dst"))
    moved = balanced_join(links, as_src, ["src"], n_parents)
    moved = balanced_join(moved, as_dst, ["dst"], n_parents)
    moved = moved.where("new_src <> new_dst").select(
        F.col("new_src").alias("src"), F.col("new_dst").alias("dst")
    )
    return _both_ways(spanning_forest(moved), work)


def _unwind(steps: list[tuple[DataFrame, int]], work: Workspace) -> DataFrame:
    """Compose the pointers from the last round back to the first."""
    parents, n_roots = steps[-1]
    roots = parents.select("id", F.col("parent").alias("root"))
    for parents, n_parents in reversed(steps[:-1]):
        onward = roots.select(F.col("id").alias("parent"), "root")
        roots = balanced_join(parents, onward, ["parent"], n_roots, "left").select(
            "id", F.coalesce("root", "parent").alias("root")
        )
        # small levels are composed in one plan, large ones written down
        if n_parents > BROADCAST_ROWS:
            roots = work.store(roots)
        n_roots = n_parents
    roots = work.store(roots)
    least = roots.groupBy("root").agg(F.min("id").alias("comp"))
    return balanced_join(roots, least, ["root"], n_roots).select("id", "comp")
