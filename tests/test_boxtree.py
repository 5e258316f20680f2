import numpy as np
import pytest

from pointcluster import kmeans, tree_kmeans
from pointcluster.functions.exprs import unpack
from pointcluster.plans import boxtree
from pointcluster.plans.boxtree import BoxTree, summarize, with_leaves


def same(points, k, **options):
    a = kmeans(points, k, max_iterations=6, tol=0.0, **options)
    b = tree_kmeans(points, k, max_iterations=6, tol=0.0, **options)
    assert np.allclose(a.centers, b.centers, rtol=0, atol=1e-12)
    assert np.allclose([r[1] for r in a.history_rows], [r[1] for r in b.history_rows], atol=1e-12)
    return a, b


@pytest.mark.parametrize("d,k", [(1, 3), (2, 5), (2, 40), (3, 7), (9, 4)])
def test_same_centers_as_lloyd(random_points, d, k):
    _, points = random_points(600, d)
    same(points, k)


def test_points_that_stand_in_few_places(make_points):
    # ties between centers, a place with a third of all rows, features that do not vary
    rows = [(0.0, 5.0)] * 60 + [(2.0, 5.0)] * 60 + [(1.0, 5.0)] * 60
    a, b = same(make_points(rows), 2, init=[[0.0, 5.0], [2.0, 5.0]])
    assert a.history_rows[0][1] > 0
    same(make_points([(1.0, 1.0)] * 9), 2, init=[[1.0, 1.0], [1.0, 1.0]])


def test_empty_cluster_is_reseeded_as_by_lloyd(random_points):
    _, points = random_points(200)
    same(points, 3, init=[[0.2, 0.2], [0.8, 0.8], [50.0, 50.0]], empty="reseed")


def test_levels_are_merged_leaves(random_points):
    x, points = random_points(3000)
    features = with_leaves(unpack(points, 2), 2)
    tree = summarize(features, 2)
    assert len(tree.levels) == 9
    for code, count, sums, lo, hi in tree.levels:
        assert count.sum() == 3000 and np.all(np.diff(code) > 0)
        assert np.allclose(sums.sum(axis=0), x.sum(axis=0))
        assert np.allclose(lo.min(axis=0), x.min(axis=0)) and np.allclose(hi.max(axis=0), x.max(axis=0))


def test_owned_boxes_hold_no_other_centers_points(random_points):
    x, points = random_points(3000)
    rows = with_leaves(unpack(points, 2), 2).toPandas()
    tree = summarize(with_leaves(unpack(points, 2), 2), 2)
    centers = x[[5, 500, 1500, 2500]]
    counts, sums, contested, _ = tree.settle(centers)
    near = ((rows[["f0", "f1"]].to_numpy()[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
    owned = ~rows["leaf"].isin(contested).to_numpy()
    assert 0 < owned.sum() < len(rows)
    assert np.array_equal(counts, np.bincount(near[owned], minlength=4))
    for j in range(4):
        assert np.allclose(sums[j], rows[["f0", "f1"]][owned & (near == j)].sum())


def test_rounds_touch_few_points(random_points, monkeypatch):
    _, points = random_points(20_000)
    touched = []
    step = boxtree.cluster_means

    def spy(rows, centers):
        found = step(rows, centers)
        touched.append(sum(n for n, _ in found.values()))
        return found

    monkeypatch.setattr(boxtree, "cluster_means", spy)
    tree_kmeans(points, 5, max_iterations=4, tol=0.0)
    assert len(touched) == 4 and max(touched) < 20_000 / 8


def test_refused_input(spark, make_points):
    none = spark.createDataFrame([], "id long, features array<double>")
    for frame in (none, spark.createDataFrame([(1, [1.0]), (2, [None])], "id long, features array<double>")):
        with pytest.raises(Exception, match="no points|exceeds|null or NaN"):
            tree_kmeans(frame, 2).centers
    wide = make_points([[float(i)] * 17 for i in range(4)])
    with pytest.raises(ValueError, match="up to 16"):
        tree_kmeans(wide, 2)


def test_one_leaf_is_a_tree():
    import pandas as pd

    leaf = pd.DataFrame({"leaf": [0], "n": [2], "sum_f0": [3.0], "min_f0": [1.0], "max_f0": [2.0]})
    tree = BoxTree(leaf, 1)
    counts, sums, contested, _ = tree.settle([[1.5], [9.0]])
    assert counts.tolist() == [2, 0] and sums.tolist() == [[3.0], [0.0]] and not len(contested)
