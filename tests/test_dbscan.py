import numpy as np
import pytest

from pointcluster import dbscan, dbscan_local_labels, label_overlap
from pointcluster.operators import components as components_module
from pointcluster.operators import joins
from pointcluster.plans.dbscan import Dbscan, Tuning, cell_side


def brute(points, eps, min_pts):
    """Textbook DBSCAN: (core ids, {id: cluster or None})."""
    rows = sorted(points.collect())
    ids = [r["id"] for r in rows]
    x = np.array([r["features"] for r in rows])
    d2 = np.zeros((len(x), len(x)))
    for i in range(x.shape[1]):
        d2 = d2 + (x[:, None, i] - x[None, :, i]) ** 2
    near = d2 <= eps * eps
    core = near.sum(axis=1) >= min_pts
    label = [None] * len(ids)
    for i in range(len(ids)):
        if core[i] and label[i] is None:
            todo = [i]
            label[i] = ids[i]  # ids are sorted, so the first found is the least
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core):
                    if label[j] is None:
                        label[j] = ids[i]
                        todo.append(j)
    for i in range(len(ids)):
        if not core[i]:
            reach = [(d2[i, j], ids[j], j) for j in np.flatnonzero(near[i] & core)]
            if reach:
                label[i] = label[min(reach)[2]]
    return {i for i, c in zip(ids, core) if c}, dict(zip(ids, label))


def run(points, eps, min_pts, tuning=None):
    rows = dbscan(points, eps, min_pts, include_noise=True, tuning=tuning).collect()
    assert len(rows) == points.count()
    return {r["point_id"]: r["cluster_id"] for r in rows}


def check(points, eps, min_pts, tuning=None):
    _, want = brute(points, eps, min_pts)
    expected = {str(i): "-1" if c is None else str(c) for i, c in want.items()}
    assert run(points, eps, min_pts, tuning) == expected


@pytest.mark.parametrize("d,eps,min_pts", [(2, 0.06, 5), (3, 0.12, 6)])
def test_against_brute_force(random_points, d, eps, min_pts):
    _, points = random_points(350, d, seed=d)
    check(points, eps, min_pts)


SMALL = Tuning(broadcast_rows=0, rows_per_salt=3, direct_pairs=1)


def test_every_branch_with_small_limits(random_points, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 3)
    monkeypatch.setattr(components_module, "BROADCAST_ROWS", 0)
    _, points = random_points(100, seed=9)
    check(points, 0.08, 5, SMALL)


def two_blocks(gap):
    """Two vertical lines of many points each, ``gap`` apart."""
    left = [(0.0, i * 1e-5) for i in range(120)]
    right = [(gap, i * 1e-5 + 3e-6) for i in range(120)]
    return left + right


@pytest.mark.parametrize("gap,clusters", [(0.0999, 1), (0.1, 2)])
def test_crowded_cells_are_split_exactly(make_points, gap, clusters):
    points = make_points(two_blocks(gap))
    found = run(points, 0.1, 5, Tuning(direct_pairs=16))
    assert len(set(found.values())) == clusters
    _, want = brute(points, 0.1, 5)
    assert found == {str(i): str(c) for i, c in want.items()}


def test_two_groups_share_only_a_border_point(make_points):
    xs = [-0.3, -0.2, -0.1, 0, 0.1, 1.05, 2, 2.1, 2.2, 2.3, 2.4]
    points = make_points([(x, 0.0) for x in xs])
    plan = Dbscan(points, 1, 5).run()
    core = {r["id"] for r in plan.core_flags().where("is_core").collect()}
    found = {r["id"]: r["cluster"] for r in plan.labels().collect()}
    edge = [r["id"] for r in plan.border().collect()]
    memberships = plan.memberships().selectExpr("id AS point_id", "cluster AS cluster_id")
    both = [(r["point_id"], r["labels"]) for r in label_overlap(memberships).collect()]
    plan.release()
    assert core == set(range(11)) - {5}
    assert {found[i] for i in range(5)} == {0} and {found[i] for i in range(6, 11)} == {6}
    assert found[5] in (0, 6) and edge == [5]
    assert both == [(5, [0, 6])]


def test_points_exactly_eps_apart(make_points):
    assert run(make_points([(0, 0), (1, 0)]), 1, 2) == {"0": "0", "1": "0"}


def test_one_cell_with_ten_thousand_points(spark):
    points = spark.range(10_000).selectExpr(
        "id", "array(0.5 + (id % 100) * 1e-6, 0.5 + (id div 100) * 1e-6) AS features"
    )
    far = spark.createDataFrame([(10_000, [0.9, 0.9])], "id long, features array<double>")
    plan = Dbscan(points.union(far), 0.05, 5)
    plan.build_cells()
    plan.find_core()
    assert plan.n_cells == 2 and plan.sparse.count() == 1
    plan.release()
    found = dbscan(points.union(far), 0.05, 5)
    assert found.count() == 10_000
    assert [r["cluster_id"] for r in found.select("cluster_id").distinct().collect()] == ["0"]


def test_copies_of_one_point_hold_a_third(random_points, spark):
    x, points = random_points(200, seed=4)
    copies = spark.range(1000, 1100).selectExpr("id", "array(0.25D, 0.25D) AS features")
    check(points.select("id", "features").union(copies), 0.05, 6, Tuning(rows_per_salt=20, broadcast_rows=0))


def test_string_ids_and_noise(make_points):
    rows = {"b": (0, 0), "a": (0.1, 0), "c": (0.2, 0), "z": (5, 5)}
    points = make_points(rows)
    assert run(points, 0.15, 2) == {"a": "a", "b": "a", "c": "a", "z": "-1"}


def test_many_partitions(random_points):
    _, points = random_points(250, seed=6)
    check(points.repartition(9), 0.06, 5)


def test_unmerged_cells_keep_their_label(make_points):
    points = make_points([(0, 0), (0.01, 0), (1, 1), (1.01, 1), (1.1, 1)])
    rows = {r["id"]: (r["local_id"], r["cluster_id"]) for r in dbscan_local_labels(points, 0.12, 2).collect()}
    assert rows[0] == (0, 0) and rows[4][1] == 2 and rows[2] == (2, 2)


def test_refusals(make_points):
    points = make_points([(0, 0), (1, 1)])
    for bad in (dict(eps=0), dict(min_pts=0), dict(limit=0)):
        with pytest.raises(ValueError):
            dbscan(points, **{"eps": 0.1, "min_pts": 2, **bad})
    with pytest.raises(ValueError):
        dbscan(points.where("id < 0"), 0.1, 2)
    with pytest.raises(ValueError):
        dbscan(make_points([(0, 0, 0, 0)]), 0.1, 2)
    with pytest.raises(ValueError):
        cell_side(1e-14, 2, 1.0)
