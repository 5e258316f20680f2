import numpy as np
import pytest
from pyspark.sql import functions as F

from pointcluster import connected_components, eps_neighbors, grid_cells
from pointcluster.operators import joins
from pointcluster.operators import components as components_module
from pointcluster.operators.joins import balanced_join, salt_table


@pytest.fixture
def tiny_limits(monkeypatch):
    """Make every join take the salted way."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 3)
    monkeypatch.setattr(components_module, "BROADCAST_ROWS", 0)


@pytest.fixture
def many_rounds(monkeypatch):
    """No graph is small enough for one task; tasks hold few nodes."""
    monkeypatch.setattr(components_module, "LOCAL_ROWS", 0)
    monkeypatch.setattr(components_module, "HELD_ROWS", 2)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.createDataFrame(
        [(i, 7 if i % 3 == 0 else i % 5) for i in range(90)], "id long, k long"
    )
    small = spark.createDataFrame([(7, "a"), (7, "b"), (1, "c"), (9, "d")], "k long, v string")
    want = sorted(map(tuple, big.join(small, ["k"], how).collect()), key=repr)
    got = balanced_join(big, small, ["k"], 4, how, broadcast_rows=0, rows_per_salt=4)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    quick = balanced_join(big, small, ["k"], 4, how)
    assert sorted(map(tuple, quick.collect()), key=repr) == want


def test_hot_keys_get_salts(spark):
    big = spark.range(100).selectExpr("IF(id < 40, 0L, id) AS k")
    table = {r["k"]: r["_salts"] for r in salt_table(big, ["k"], rows_per_salt=10).collect()}
    assert table == {0: 4}
    assert salt_table(big, ["k"], rows_per_salt=40) is None


def components_of(spark, edges):
    frame = spark.createDataFrame(edges, "src long, dst long")
    found = connected_components(frame)
    return {r["id"]: r["comp"] for r in found.labels.collect()}, found.rounds


def union_find(edges):
    parent = {}

    def find(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def test_shuffled_chain_ends_soon(spark, many_rounds):
    order = [int(v) for v in np.random.default_rng(3).permutation(1000)]
    got, rounds = components_of(spark, list(zip(order, order[1:])))
    assert got == dict.fromkeys(range(1000), 0)
    assert 0 < rounds <= 15


def test_ordered_chain_ends_soon(spark, many_rounds):
    got, rounds = components_of(spark, [(i, i + 1) for i in range(199)])
    assert got == dict.fromkeys(range(200), 0) and rounds <= 15


@pytest.mark.parametrize("local", [0, 20, 10**6])
def test_random_graphs_self_loops_and_a_hub(spark, monkeypatch, local):
    monkeypatch.setattr(components_module, "LOCAL_ROWS", local)
    rng = np.random.default_rng(5)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 300, (180, 2))]
    edges += [(500, 500)] + [(1000, 1000 + i) for i in range(1, 60)]
    assert components_of(spark, edges)[0] == union_find(edges)


def test_salted_components(spark, tiny_limits, many_rounds):
    edges = [(0, i) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 200)]
    assert components_of(spark, edges)[0] == union_find(edges)


def test_null_ends_and_repeated_edges(spark):
    got, _ = components_of(spark, [(3, None), (None, 4), (None, None), (1, 2), (2, 1), (1, 2)])
    assert got == {3: 3, 4: 4, 1: 1, 2: 1}


def test_string_nodes(spark):
    edges = [("b", "a"), ("é", "z"), ("z", "c"), ("q", "q")]
    frame = spark.createDataFrame(edges, "src string, dst string").repartition(2)
    got = {r["id"]: r["comp"] for r in connected_components(frame).labels.collect()}
    assert got == {"a": "a", "b": "a", "é": "c", "z": "c", "c": "c", "q": "q"}


@pytest.mark.parametrize("shape", ["star", "chain", "copies"])
def test_forest_has_fewer_rows_than_nodes(spark, shape):
    n = 5_000
    to = {"star": "0L", "chain": "greatest(id - 1, 0)", "copies": "id % 10"}[shape]
    edges = spark.range(n * (20 if shape == "copies" else 1)).selectExpr(
        f"id % {n} AS src", f"{to} AS dst").repartition(4)
    forest = components_module.spanning_forest(edges)
    per_task = forest.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("rows"), F.countDistinct("src").alias("nodes")).collect()
    assert all(r["rows"] == r["nodes"] <= n for r in per_task)
    found = connected_components(edges).labels
    assert found.count() == n and found.where("comp >= 10").count() == 0


def test_no_edges(spark):
    assert components_of(spark, [])[0] == {}
    assert components_of(spark, [(4, 4)])[0] == {4: 4}


def neighbors(x, eps):
    d2 = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    return {(int(i), int(j)) for i, j in zip(*np.nonzero(d2 <= eps * eps))}


@pytest.mark.parametrize("d", [1, 2, 3])
def test_neighbors_match_brute_force(random_points, d):
    x, points = random_points(250, d)
    want = neighbors(x, 0.07)
    got = eps_neighbors(points, 0.07)
    assert {(r["id"], r["neighbor_id"]) for r in got.collect()} == want
    salted = eps_neighbors(points, 0.07, pairs_per_task=50)
    assert sorted((r["id"], r["neighbor_id"]) for r in salted.collect()) == sorted(want)
    assert got.count() == len(want)


def test_crowded_cell_is_cut_on_both_sides(spark, make_points):
    """10,000 points in one cell: no two parts meet in more tests than the budget."""
    from pointcluster.operators.neighbors import pair_salts, with_cells

    points = spark.range(10_000).selectExpr(
        "id", "array(CAST(id AS DOUBLE) * 10, CAST(id % 7 AS DOUBLE) * 10) AS features"
    )
    budget = 1_000_000
    crowd = with_cells(points, 2, [0.0, 0.0], 1e6)
    cut = pair_salts(crowd, ["c0", "c1"], budget).first()
    assert cut["_sl"] > 1 and cut["_sr"] > 1
    assert 10_000 / cut["_sl"] * 10_000 / cut["_sr"] <= budget
    assert cut["_sl"] * cut["_sr"] <= 4 * 10_000**2 / budget
    got = eps_neighbors(points, 10.0, pairs_per_task=budget)
    assert pair_salts(crowd, ["c0", "c1"], 10**9) is None
    x = points.collect()
    want = sum(
        1
        for i in range(10_000)
        for j in range(max(0, i - 1), min(10_000, i + 2))
        if (10 * (i - j)) ** 2 + (10 * (i % 7 - j % 7)) ** 2 <= 100
    )
    assert got.count() == want and len(x) == 10_000


def test_neighbors_plan_is_an_equi_join(random_points):
    _, points = random_points(50)
    text = eps_neighbors(points, 0.1)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_eps_is_inclusive(make_points):
    pairs = eps_neighbors(make_points([(0, 0), (1, 0), (2.5, 0)]), 1.0)
    got = {(r["id"], r["neighbor_id"]) for r in pairs.collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (0, 1), (1, 0)}


def test_cells(make_points):
    got = {r["id"]: (r["c0"], r["c1"]) for r in grid_cells(make_points([(1, 1), (2.5, 1)]), 1).collect()}
    assert got == {0: (0, 0), 1: (1, 0)}
    with pytest.raises(ValueError):
        grid_cells(make_points([(1, 1, 1, 1)]), 1.0)
    with pytest.raises(ValueError):
        grid_cells(make_points([(1, 1)]), 0)


def test_tasks_of_the_neighbour_join_follow_its_tests(spark, monkeypatch):
    """20,000 points are few bytes but many tests: no sort, and tasks by the tests."""
    from pointcluster.operators import neighbors as module

    monkeypatch.setattr(module, "TASK_PAIRS", 10**12)
    points = spark.range(20_000).selectExpr(
        "id", "array(CAST(id % 100 AS DOUBLE) / 100, CAST(id % 7 AS DOUBLE) / 7) AS features"
    )
    found = eps_neighbors(points, 0.2, pairs_per_task=10_000_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert found.rdd.getNumPartitions() >= 10
    xs, counts = [(i % 100 / 100, i % 7 / 7) for i in range(700)], 20_000 // 700
    assert found.where("id = 350").count() > counts * sum(
        1 for x in xs if (x[0] - 0.5) ** 2 + x[1] ** 2 < 0.039
    )


def test_rounded_is_round(spark):
    from pointcluster.functions.exprs import rounded

    values = [0.0, 2.5e-9, 3.5e-9, 1.25e-5, 0.5e-9, 1.0000000005, 7.4999999e-9, 123456.789, -2.5e-9, -3.2e-9, 1e300]
    rows = spark.createDataFrame([(v,) for v in values + [i * 1.7e-10 for i in range(2_000)]], "v double")
    assert rows.where(f"NOT ({rounded('v', 9)} <=> round(v, 9))").count() == 0


@pytest.mark.parametrize("crowded", [False, True])
def test_spanning_pairs_keep_the_components(spark, monkeypatch, crowded):
    """Repeated and null ids, equal points; about a row per point, not one per pair."""
    from pointcluster.plans import dbscan_ranges

    monkeypatch.setattr(dbscan_ranges, "RANGE_POINTS", 40)
    if crowded:
        monkeypatch.setattr(dbscan_ranges, "TILE_POINTS", 3)
    x = np.random.default_rng(5).random((400, 2))
    x[:120] = x[:120] * 0.05
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)]
    rows += rows[:30] + [(7, [0.9, 0.9]), (None, [0.5, 0.5]), (None, [0.52, 0.5]), (901, [0.54, 0.5])]
    points = spark.createDataFrame(rows, "id long, features array<double>").repartition(3)

    def labels(pairs):
        edges = pairs.selectExpr("id AS src", "neighbor_id AS dst")
        return sorted(tuple(r) for r in connected_components(edges).labels.collect())

    pairs, few = eps_neighbors(points, 0.03), eps_neighbors(points, 0.03, spanning=True)
    assert labels(few) == labels(pairs)
    assert few.count() < 5 * len(rows) < pairs.count()


def shuffled_rows(df):
    """Rows that the exchanges of a collected frame wrote."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        metrics = node.metrics()
        own = metrics.apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        below = node.children()
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_neighbours_shuffle_a_point_about_once(spark):
    """Each point went to the nine cells around it and to its own, ten rows a point."""
    points = spark.range(5_000).selectExpr(
        "id", "array(CAST(id % 71 AS DOUBLE) / 71, CAST(id % 97 AS DOUBLE) / 97) AS features"
    )
    found = eps_neighbors(points, 0.02)
    assert 5_000 <= shuffled_rows(found) <= 3 * 5_000


@pytest.mark.parametrize("budget", [50, 20_000, 10**6])
@pytest.mark.parametrize("bits", [62, 5])
def test_neighbours_with_repeated_and_null_ids(spark, monkeypatch, budget, bits):
    """Each row is a point of its own; crowded cells, long lines of cells, few places."""
    from pointcluster.plans import eps_pairs

    monkeypatch.setattr(eps_pairs, "KEY_BITS", bits)
    monkeypatch.setattr(eps_pairs, "DENSE", 100)
    monkeypatch.setattr(eps_pairs, "BLOCK", 30)
    x = np.random.default_rng(9).random((300, 2))
    x[:150] = x[:150] * 0.04 + 0.5
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(x)]
    rows += rows[:40] + [(None, [0.5, 0.51]), (None, [0.5, 0.51]), (None, [0.0, 1.0]), (7, [0.52, 0.5])]
    points = spark.createDataFrame(rows, "id long, features array<double>").repartition(3)
    want = sorted(
        (str(i), str(j), (a - c) * (a - c) + (b - d) * (b - d))
        for i, (a, b) in rows
        for j, (c, d) in rows
        if (a - c) * (a - c) + (b - d) * (b - d) <= 0.03 * 0.03
    )
    got = eps_neighbors(points, 0.03, pairs_per_task=budget).collect()
    assert sorted((str(r[0]), str(r[1]), r[2]) for r in got) == want
