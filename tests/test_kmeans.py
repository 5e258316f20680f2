import numpy as np
import pytest

from pointcluster import (
    assign_nearest,
    centroid_distances,
    elkan_init,
    elkan_kmeans,
    elkan_step,
    inertia,
    kmeans,
    predict_nearest,
)
from pointcluster.functions import exprs
from pointcluster.operators import nearest
from pointcluster.operators.nearest import centroid_frame
from pointcluster.plans import elkan as elkan_plan
from pointcluster.plans import kmeans as lloyd_plan


def reference(x, centers, rounds):
    centers = np.array(centers)
    for _ in range(rounds):
        d2 = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
        label = d2.argmin(axis=1)
        centers = np.array(
            [x[label == j].mean(axis=0) if (label == j).any() else c for j, c in enumerate(centers)]
        )
    return centers


@pytest.mark.parametrize("d,k", [(2, 5), (2, 40), (30, 6)])
def test_lloyd_and_elkan_match_numpy(random_points, d, k):
    x, points = random_points(400, d)
    a = kmeans(points, k, max_iterations=7, tol=0.0)
    b = elkan_kmeans(points, k, max_iterations=7, tol=0.0)
    start = lloyd_plan.initial_centers(points, k, 42)
    want = reference(x, start, 7)
    assert np.allclose(a.centers, want, atol=1e-9)
    assert np.allclose(b.centers, want, atol=1e-9)
    assert sum(r[2] for r in b.history_rows) < sum(r[2] for r in a.history_rows)
    assert a.history_rows[0][2] == 400 * k


def test_array_state_matches_column_state(random_points, monkeypatch):
    _, points = random_points(300)
    a = elkan_kmeans(points, 4, max_iterations=6, tol=0.0)
    monkeypatch.setattr(elkan_plan, "MAX_COLUMNS", 0)
    b = elkan_kmeans(points, 4, max_iterations=6, tol=0.0)
    assert a.centers == b.centers
    assert [r[2] for r in a.history_rows] == [r[2] for r in b.history_rows]


def test_unrolled_matches_blocks(random_points, monkeypatch):
    _, points = random_points(300)
    a = kmeans(points, 4, max_iterations=4, tol=0.0)
    labels = sorted(map(tuple, a.assign().select("id", "cluster_id").collect()))
    for module in (nearest, lloyd_plan):
        monkeypatch.setattr(module, "unrolls", lambda k, d: False)
    b = kmeans(points, 4, max_iterations=4, tol=0.0)
    assert np.allclose(a.centers, b.centers, atol=1e-12)
    assert labels == sorted(map(tuple, b.assign().select("id", "cluster_id").collect()))
    assert exprs.unrolls(5, 2)


def test_bounds_stay_bounds(random_points):
    x, points = random_points(200)
    old = lloyd_plan.initial_centers(points, 4, 1)
    new = [[v + 0.03 for v in c] for c in old]
    exact = np.sqrt(((x[:, None, :] - np.array(new)[None]) ** 2).sum(axis=2))
    for r in elkan_step(points, old, new).collect():
        true = exact[r["id"]]
        assert r["u"] >= true[r["c"]] - 1e-12
        assert all(low <= t + 1e-12 for low, t in zip(r["l"], true))
        assert true[r["c"]] <= true.min() + 1e-12
    first = elkan_init(points, old).first()
    assert first["n_dist"] == 4 and first["u"] == min(first["l"])


def test_tie_goes_to_the_lower_index(make_points, spark):
    points = make_points([(1.0, 0.0)])
    found = assign_nearest(points, centroid_frame(spark, [[0, 0], [2, 0]]))
    assert found.first()["cluster_id"] == 0


def test_stored_ids_are_kept(make_points, spark):
    points = make_points([(0, 0), (5, 5)])
    found = assign_nearest(points, centroid_frame(spark, [[5, 5], [0, 0]], ids=[3, 7]))
    assert {r["id"]: r["cluster_id"] for r in found.collect()} == {0: 7, 1: 3}


def test_equal_start_centers(make_points):
    points = make_points([(0, 0), (1, 0), (2, 0)])
    for fit in (kmeans, elkan_kmeans):
        run = fit(points, 2, init=[[1, 0], [1, 0]], max_iterations=3)
        assert run.centers == [[1.0, 0.0], [1.0, 0.0]]


def test_empty_cluster_is_reseeded(make_points):
    points = make_points([(0, 0), (0, 1), (9, 9), (9, 8)])
    run = kmeans(points, 2, init=[[0, 0], [100, 100]], max_iterations=1, empty="reseed", tol=0)
    assert run.centers[0] != [0, 0]
    keep = kmeans(points, 2, init=[[4, 4], [100, 100]], max_iterations=1, tol=0)
    assert keep.centers[1] == [100.0, 100.0]
    again = kmeans(points, 2, init=[[4, 4], [100, 100]], max_iterations=1, empty="reseed", tol=0)
    assert again.centers[1] in [[0, 0], [0, 1], [9, 9], [9, 8]]


def test_refusals(make_points):
    points = make_points([(0, 0), (1, 1)])
    for fit in (kmeans, elkan_kmeans):
        with pytest.raises(ValueError):
            fit(points, 3)
        with pytest.raises(ValueError):
            fit(points, 1, limit=0)
        with pytest.raises(ValueError):
            fit(points.where("id < 0"), 1)
        with pytest.raises(ValueError):
            fit(points, 1, empty="drop")
        with pytest.raises(ValueError):
            fit(points, 0)


def test_stop_rules(random_points):
    _, points = random_points(200)
    run = kmeans(points, 3, max_iterations=50, tol=1e-3)
    shifts = [r[1] for r in run.history_rows]
    assert shifts[-1] < 1e-3 and all(s >= 1e-3 for s in shifts[:-1])
    a = kmeans(points, 3, max_iterations=1, tol=0)
    b = kmeans(points, 3, max_iterations=1, tol=0, shift_norm="l2")
    assert b.history_rows[0][1] < a.history_rows[0][1]


def test_partitioning_does_not_matter_and_inertia_falls(random_points):
    _, points = random_points(300)
    costs = []
    for rounds in (1, 2, 4):
        run = kmeans(points, 4, max_iterations=rounds, tol=0)
        costs.append(inertia(run.assign(), run.centroids).first()[0])
    assert costs[0] >= costs[1] >= costs[2]
    one = kmeans(points.coalesce(1), 4, max_iterations=4, tol=0)
    many = kmeans(points.repartition(13), 4, max_iterations=4, tol=0)
    assert np.allclose(one.centers, many.centers, atol=1e-12)


def test_a_cluster_with_most_rows(make_points):
    rows = [(0.5, 0.5)] * 300 + [(i / 50, 1 - i / 50) for i in range(50)]
    points = make_points(rows)
    a = kmeans(points, 3, max_iterations=5, tol=0)
    b = elkan_kmeans(points, 3, max_iterations=5, tol=0)
    assert np.allclose(a.centers, b.centers, atol=1e-12)
    assert a.assign().count() == 350


def test_predictions_keep_ids_and_scale(spark, make_points):
    from pointcluster import fit_minmax

    raw = spark.createDataFrame(
        [("a", -74.0, 40.6, 1), ("b", -73.8, 40.8, 2), ("c", -80.0, 40.8, 2)],
        "id string, pickup_longitude double, pickup_latitude double, passenger_count int",
    )
    scaler = fit_minmax(make_points([(-74.0, 40.6), (-73.8, 40.8)]))
    found = predict_nearest(raw, scaler, centroid_frame(spark, [[0, 0], [1, 1]], ids=[3, 7]))
    rows = {r["point_id"]: r for r in found.collect()}
    assert {i: r["cluster_id"] for i, r in rows.items()} == {"a": 3, "b": 7}
    assert rows["b"]["scaled_longitude"] == pytest.approx(1.0)


def test_center_distances(spark):
    pairs, gaps = centroid_distances(centroid_frame(spark, [[0, 0], [3, 4], [0, 2]]))
    table = {(r["i"], r["j"]): r["dist"] for r in pairs.collect()}
    assert table[(0, 1)] == 5.0 and table[(1, 1)] == 0.0 and len(table) == 9
    assert {r["i"]: r["half_gap"] for r in gaps.collect()}[0] == 1.0


@pytest.mark.parametrize("k", [1, 4, 30])
def test_parallel_start_matches_the_same_draws(make_points, k):
    import hashlib

    from pointcluster.plans import seeding

    rng = np.random.default_rng(k)
    x = np.concatenate([rng.normal(c, 0.05, (60, 2)) for c in ((0, 0), (3, 0), (0, 3), (3, 3))])
    points = make_points([tuple(v) for v in x])
    seed = 5
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    found = [min(range(len(x)), key=lambda i: digest(f"{seed}:{i}"))]
    for step in (1, 2):
        d2 = ((x[:, None] - x[found][None]) ** 2).sum(axis=2).min(axis=1)
        draws = np.array([int(digest(f"{seed}:{step}:{i}")[:13], 16) / 2**52 for i in range(len(x))])
        found += np.flatnonzero(draws * d2.sum() < 2 * k * d2).tolist()
    near = ((x[:, None] - x[found][None]) ** 2).sum(axis=2).argmin(axis=1)
    weights = np.bincount(near, minlength=len(found)).tolist()
    want = seeding.reclustered(x[found].tolist(), weights, k)
    got = seeding.parallel_start(points, k, seed)
    assert len(got) == k and np.allclose(got[: len(want)], want)
    assert np.allclose(got, seeding.parallel_start(points.repartition(5), k, seed))
    if k == 4:  # one center per group
        assert sorted(tuple(np.rint(c).astype(int)) for c in got) == [(0, 0), (0, 3), (3, 0), (3, 3)]


def test_parallel_start_of_few_or_equal_points(make_points):
    from pointcluster.plans.seeding import parallel_start

    same = make_points([(1.0, 2.0)] * 6)
    assert parallel_start(same, 3, 1) == [[1.0, 2.0]] * 3
    with pytest.raises(ValueError):
        parallel_start(same, 7, 1)
    with pytest.raises(ValueError):
        kmeans(same, 2, init="random")
    runs = [f(make_points([(0.0, 0.0), (1.0, 0.0), (9.0, 9.0)]), 2, init="k-means||") for f in (kmeans, elkan_kmeans)]
    assert sorted(runs[0].centers) == sorted(runs[1].centers) == [[0.5, 0.0], [9.0, 9.0]]
