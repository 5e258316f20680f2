import numpy as np
import pytest

from pointcluster import assign_nearest
from pointcluster.operators import centerindex, nearest
from pointcluster.operators.centerindex import CenterIndex
from pointcluster.operators.nearest import centroid_frame, nearest_block


def brute(x, centers):
    index = np.empty(len(x), int)
    best = np.empty(len(x))
    for i, row in enumerate(x):
        d2 = ((row - centers) ** 2).sum(axis=1)
        index[i], best[i] = d2.argmin(), d2.min()
    return index, best


def same(x, centers, fallback=nearest_block):
    index, best = CenterIndex(centers, fallback).nearest(x)
    want, far = brute(x, centers)
    assert np.array_equal(index, want) and np.array_equal(best, far)


def refused(x, centers):
    raise AssertionError("the tree is enough")


@pytest.mark.parametrize("k", [1, 15, 16, 17, 33, 1000])
@pytest.mark.parametrize("d", [1, 2, 5])
def test_equals_brute_force(k, d):
    rng = np.random.default_rng(k + d)
    same(rng.normal(size=(300, d)), rng.normal(size=(k, d)))


def test_ties_take_the_least_index():
    grid = np.array([(i, j) for i in range(30) for j in range(30)], float)
    same(np.concatenate([grid + 0.5, grid, grid + [0.5, 0.0]]), np.concatenate([grid, grid]))
    same(np.zeros((5, 2)), np.ones((500, 2)))
    same(np.zeros((0, 2)), grid)


def test_hundred_thousand_centers_in_the_plane_open_few_leaves(monkeypatch):
    rng = np.random.default_rng(3)
    centers, x = rng.random((100_000, 2)) ** 3, rng.random((400, 2)) ** 3
    compared = []
    real = CenterIndex._best

    def spy(self, x, points, leaves, *rest):
        compared.append(len(leaves))
        real(self, x, points, leaves, *rest)

    monkeypatch.setattr(CenterIndex, "_best", spy)
    same(x, centers, refused)
    assert sum(compared) < 8 * len(x)


def test_hundred_thousand_centers_in_64_dimensions():
    rng = np.random.default_rng(4)
    hubs = rng.random((500, 64))
    centers = hubs[rng.integers(0, 500, 100_000)] + rng.normal(0, 0.002, (100_000, 64))
    same(hubs[rng.integers(0, 500, 60)] + rng.normal(0, 0.002, (60, 64)), centers, refused)
    same(rng.random((20, 64)), centers)


def test_little_memory_gives_the_same(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(centerindex, "PAIRS", 50)
    same(rng.random((60, 3)), rng.random((700, 3)))


def test_fallback_takes_points_that_open_much():
    rng = np.random.default_rng(6)
    asked = []

    def blocks(x, centers):
        asked.append(len(x))
        return nearest_block(x, centers)

    same(rng.random((50, 30)), rng.random((4000, 30)), blocks)
    assert sum(asked) > 0


def test_assign_nearest_by_the_tree(random_points, spark, monkeypatch):
    _, points = random_points(500)
    rng = np.random.default_rng(7)
    centers, ids = rng.random((300, 2)), (rng.permutation(300) * 7).tolist()
    frame = centroid_frame(spark, centers, ids)
    want = sorted(assign_nearest(points, frame).select("id", "cluster_id", "dist_sq").collect())
    monkeypatch.setattr(nearest, "INDEX_MIN_CENTERS", 100)
    assert sorted(assign_nearest(points, frame).select("id", "cluster_id", "dist_sq").collect()) == want


def test_null_feature_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nearest, "INDEX_MIN_CENTERS", 30)
    points = spark.createDataFrame([(1, [1.0, None])], "id long, features array<double>")
    frame = centroid_frame(spark, np.random.default_rng(8).random((50, 2)))
    with pytest.raises(Exception, match="null or NaN"):
        assign_nearest(points, frame).collect()
