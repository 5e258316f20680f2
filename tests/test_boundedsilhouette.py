"""The Euclidean silhouette of all rows lies within its stated bound of the exact one."""

import math

import numpy as np
import pytest

from pointcluster import silhouette_euclid, silhouette_euclid_all
from pointcluster.plans import boundedsilhouette
from pointcluster.plans.boundedsilhouette import MomentTree, silhouette_bounds


def exact(x, labels):
    """Silhouettes by all pairs."""
    names = sorted(set(labels))
    labels = np.array(labels)
    out = np.zeros(len(x))
    for i in range(len(x)):
        dist = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        own = labels == labels[i]
        if own.sum() == 1:
            continue
        a = dist[own].sum() / (own.sum() - 1)
        b = min(dist[labels == v].mean() for v in names if v != labels[i])
        out[i] = (b - a) / max(a, b) if max(a, b) else 0.0
    return out


def frame(spark, x, labels, kind="int"):
    rows = [(i, [float(v) for v in p], lab) for i, (p, lab) in enumerate(zip(x, labels))]
    return spark.createDataFrame(
        rows, f"id long, features array<double>, cluster_id {kind}"
    ).repartition(3)


def check(spark, x, labels, kind="int", tolerance=0.005):
    want = exact(x, labels)
    df = frame(spark, x, labels, kind)
    got = {r["id"]: r for r in silhouette_bounds(df, tolerance).collect()}
    assert sorted(got) == list(range(len(x)))
    for i, value in enumerate(want):
        assert got[i]["sil_low"] - 1e-9 <= value <= got[i]["sil_high"] + 1e-9
    row = silhouette_euclid_all(df, "x", tolerance).first()
    assert abs(row["silhouette_score"] - want.mean()) <= row["error_bound"] + 1e-9
    assert (row["k"], row["n_points"]) == (len(set(labels)), len(x))
    return row


@pytest.mark.parametrize("d,leaves", [(1, 64), (2, 200), (2, 1 << 18), (3, 500), (7, 1 << 18)])
def test_bounds_hold(spark, monkeypatch, d, leaves):
    """Few leaves hold many points each; a third of the rows share a crowded place."""
    monkeypatch.setattr(boundedsilhouette, "LEAVES", leaves)
    rng = np.random.default_rng(d)
    x = rng.normal(size=(900, d))
    x[:300] = x[:300] * 0.01 + 2
    labels = ((x[:, 0] > 1).astype(int) + 2 * (x[:, -1] > 0) + (rng.random(900) < 0.05)).tolist()
    row = check(spark, x + 1e3, labels)
    if leaves == 1 << 18:
        assert row["error_bound"] < {2: 0.005, 7: 0.5}[d]


def test_ten_thousand_rows_against_the_sampled_operator(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(c, 0.6, size=(2_500, 2)) for c in ((0, 0), (3, 0), (0, 3), (4, 4))])
    centers = np.array([(0, 0), (3, 0), (0, 3), (4, 4)])
    labels = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    df = frame(spark, x, labels)
    row = silhouette_euclid_all(df, "x").first()
    whole = silhouette_euclid(df, "x", 10_000).first()
    assert whole["silhouette_sample_size"] == 10_000
    gap = abs(row["silhouette_score"] - whole["silhouette_score"])
    assert gap <= row["error_bound"] < 0.01 and gap < 1e-3
    assert row["n_boxes"] < 0.35 * 10_000**2  # pairs of all rows


def test_looser_tolerance_takes_fewer_boxes(spark):
    rng = np.random.default_rng(4)
    x = rng.random((3_000, 2))
    labels = (x[:, 0] * 3).astype(int).tolist()
    rows = [check(spark, x, labels, tolerance=t) for t in (0.001, 0.01, 0.1)]
    assert rows[0]["n_boxes"] > rows[1]["n_boxes"] > rows[2]["n_boxes"]
    assert rows[0]["error_bound"] < rows[1]["error_bound"] < rows[2]["error_bound"]


def test_strips_are_halved_where_pairs_are_many(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.random((200, 2))
    code = rng.integers(0, 256, 200)
    tree = MomentTree(
        np.arange(200) % 3, code * 1000 + np.arange(200), np.ones(200, int), x, np.zeros(200), 2, 9
    )
    whole = tree.sums(x, 0.01)
    monkeypatch.setattr(boundedsilhouette, "PAIRS", 50)
    parts = tree.sums(x, 0.01)
    np.testing.assert_allclose(whole[0].ravel(), np.asarray(parts[0]).ravel())
    np.testing.assert_allclose(whole[1].ravel(), np.asarray(parts[1]).ravel())


def test_rows_of_one_place_walk_together(monkeypatch):
    """What a crowded place meets is met by all its rows at once, with the sums of each alone."""
    rng = np.random.default_rng(6)
    n, bits = 30_000, 6
    points = rng.random((n, 2))
    slices = np.minimum((points * 2**bits).astype(np.int64), 2**bits - 1)
    place = sum((slices[:, i] >> b & 1) << (2 * b + i) for i in range(2) for b in range(bits))
    order = np.argsort(place, kind="stable")
    points, place = points[order], place[order]
    own = (points[:, 0] * 3).astype(int)
    keys, leaf = np.unique(np.stack([own, place]), axis=1, return_inverse=True)
    count = np.bincount(leaf.ravel())
    mean, square = (
        np.stack([np.bincount(leaf.ravel(), v) for v in w.T], axis=1) / count[:, None]
        for w in (points, points**2)
    )
    scatter = np.maximum(square - mean**2, 0).sum(axis=1) * count
    tree = MomentTree(keys[0], keys[1], count, mean, scatter, 2, bits)
    parts = list(boundedsilhouette.near_rows(place, 2, bits))
    rows = np.concatenate([np.arange(n)[p] for p in parts])
    assert sorted(rows.tolist()) == list(range(n))
    part = max(parts, key=lambda p: p.stop - p.start)
    met_alone = 0
    whole = MomentTree._one_by_one

    def noted(x, row, *more):
        nonlocal met_alone
        met_alone += len(row)
        return whole(x, row, *more)

    monkeypatch.setattr(MomentTree, "_one_by_one", staticmethod(noted))
    lower, gap, met = tree.sums(points[part], 0.002)
    assert 0 < met_alone < 0.35 * met
    monkeypatch.undo()
    alone = [tree.sums(points[i : i + 1], 0.002) for i in range(part.start, part.stop)]
    np.testing.assert_allclose(lower, np.concatenate([a[0] for a in alone]))
    np.testing.assert_allclose(gap, np.concatenate([a[1] for a in alone]))
    assert met == sum(a[2] for a in alone)


def test_ties_single_points_strings_and_nulls(spark):
    x = np.array([[0.0, 0.0]] * 40 + [[1.0, 1.0]] * 20 + [[5.0, 5.0]] + [[0.0, 0.0]] * 9)
    labels = ["a"] * 40 + ["b"] * 20 + ["alone"] + ["b"] * 9
    row = check(spark, x, labels, "string")
    assert row["error_bound"] < 1e-9  # leaves of coinciding points are exact
    same = np.zeros((12, 2))
    assert check(spark, same, [1] * 6 + [2] * 6)["silhouette_score"] == 0
    named = frame(spark, x, [None if v == "alone" else v for v in labels], "string")
    found = silhouette_euclid_all(named, "x").first()
    keep = [i for i, v in enumerate(labels) if v != "alone"]
    want = exact(x[keep], [labels[i] for i in keep]).mean()
    assert found["n_points"] == 69 and found["silhouette_score"] == pytest.approx(want, abs=1e-9)


def test_one_label_and_empty_tables(spark):
    df = frame(spark, np.zeros((5, 2)), [3] * 5)
    row = silhouette_euclid_all(df, "x").first()
    assert (row["k"], row["n_points"]) == (1, 5) and math.isnan(row["silhouette_score"])
    assert all(math.isnan(r["sil_low"]) for r in silhouette_bounds(df).collect())
    empty = silhouette_euclid_all(df.limit(0), "x").first()
    assert (empty["k"], empty["n_points"]) == (0, 0) and math.isnan(empty["error_bound"])
    with pytest.raises(ValueError):
        silhouette_euclid_all(df, "x", 0)
    bad = spark.createDataFrame(
        [(1, [1.0, None], 0), (2, [1.0, 2.0], 1)], "id long, features array<double>, cluster_id int"
    )
    with pytest.raises(Exception, match="null or NaN"):
        silhouette_euclid_all(bad, "x").first()
