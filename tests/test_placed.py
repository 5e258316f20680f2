"""Tables laid out by place: what a box reads falls with its share of the rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointcluster.functions.curve import quantile_cuts, slices_of, with_place
from pointcluster.sources.placed import (
    read_placed,
    read_placed_points,
    write_placed,
    write_placed_points,
)

SIZES = {"rows_per_folder": 10_000, "rows_per_group": 1_000}


def rows_read(df):
    """Result rows and rows that the scan gave out, by the metric the event log stores."""
    found = df.collect()

    def scans(plan):
        if plan.nodeName().startswith("Scan parquet"):
            yield plan.metrics().get("numOutputRows").get().value()
        for i in range(plan.children().size()):
            yield from scans(plan.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    return found, sum(scans(plan))


@pytest.fixture(scope="module")
def spread(spark):
    """100,000 rows, a third of them on one point."""
    u = "pmod(xxhash64(id, {}), 1000000) / 1e6D"
    return spark.range(100_000).selectExpr(
        "id", *[f"IF(id % 3 = 0, 0.9D, {u.format(i)}) AS {n}" for i, n in enumerate("xy")]
    )


def test_rows_read_fall_with_the_box(spark, spread, tmp_path):
    path, plain = str(tmp_path / "placed"), str(tmp_path / "plain")
    write_placed(spread, path, ["x", "y"], **SIZES)
    spread.write.option("parquet.block.row.count.limit", 1_000).parquet(plain)
    assert read_placed(spark, path).count() == 100_000
    for side in (0.05, 0.2, 0.6):
        box = {"x": (0.1, 0.1 + side), "y": (0.2, 0.2 + side)}
        test = f"x > 0.1 AND x < {0.1 + side} AND y > 0.2 AND y < {0.2 + side}"
        found, read = rows_read(read_placed(spark, path, box))
        want = spread.where(test).collect()
        assert sorted(found) == sorted(want)
        # the box's own rows and a rim of row groups around it
        assert read <= len(want) + 6_000 + 30_000 * side, (side, len(want), read)
        _, all_read = rows_read(spark.read.parquet(plain).where(test))
        assert all_read == 100_000


def test_a_hot_place_is_split(spark, spread, tmp_path):
    path = str(tmp_path / "placed")
    write_placed(spread, path, ["x", "y"], **SIZES)
    hot = read_placed(spark, path, {"x": (0.89, 0.91), "y": (0.89, 0.91)})
    files = hot.where("id % 3 = 0").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 33_334
    assert len(files) >= 3 and max(r["count"] for r in files) < 20_000


def test_folders_that_miss_the_box_are_not_opened(spark, spread, tmp_path):
    path = str(tmp_path / "placed")
    write_placed(spread, path, ["x", "y"], **SIZES)
    folders = [f for f in os.listdir(path) if f.startswith("_folder=")]
    assert 8 <= len(folders) <= 16
    near = read_placed(spark, path, {"x": (0.0, 0.05), "y": (0.0, 0.05)})
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_folder" in plan
    near.collect()
    kept = near.select(F.input_file_name()).distinct().count()
    assert kept <= 2


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_slices_are_counts_of_cuts_below(spark, bits):
    rng = np.random.default_rng(bits)
    values = [*np.round(rng.normal(size=300), 1).tolist(), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, -v) for v in values], "a double, b double")
    n, cuts = quantile_cuts(df, ["a", "b"], bits)
    assert n == len(values) and [len(c) for c in cuts] == [2**bits - 1] * 2
    for r in with_place(df, ["a", "b"], cuts, "z").collect():
        want = [sum(c < v for c in cut) for v, cut in zip((r["a"], r["b"]), cuts)]
        assert slices_of(r["z"], 2, bits) == want


def test_nulls_ties_clashes_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(None, 1.0, "a", 1), (2.0, None, "b", 2), (float("nan"), 1.0, None, 3)]
    rows += [(1.0, 1.0, "same", 4)] * 5
    form = "`x.y` double, b double, _folder string, _place int"
    df = spark.createDataFrame(rows, form)
    for sizes in ({}, {"rows_per_folder": 2, "rows_per_group": 1}):
        write_placed(df, path, ["x.y", "b"], **sizes)
        back = read_placed(spark, path)
        assert back.columns == df.columns
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
        inside = read_placed(spark, path, {"x.y": (0.0, 9.0), "b": (0.0, 2.0)}).collect()
        assert [r["_place"] for r in inside] == [4] * 5
        # a column that rows are not placed by filters all the same
        assert read_placed(spark, path, {"_place": (1.5, 3.5)}).count() == 2
    write_placed(df.limit(0), path, ["b"])  # replaces
    assert read_placed(spark, path).columns == df.columns
    assert read_placed(spark, path, {"b": (0.0, 1.0)}).count() == 0
    with pytest.raises(ValueError):
        write_placed(df, path, [])


def test_placed_points(spark, random_points, tmp_path):
    path = str(tmp_path / "points")
    x, points = random_points(2_000, d=3)
    write_placed_points(points, path, rows_per_folder=200, rows_per_group=50)
    box = [(0.4, 0.5), (0.1, 0.9), (0.4, 0.7)]
    found = read_placed_points(spark, path, box)
    inside = np.all([(x[:, i] > lo) & (x[:, i] < hi) for i, (lo, hi) in enumerate(box)], axis=0)
    assert {r["id"]: tuple(r["features"]) for r in found.collect()} == {
        int(i): tuple(x[i]) for i in np.flatnonzero(inside)
    }
    assert read_placed_points(spark, path).count() == 2_000
    bad = spark.createDataFrame([(1, [1.0, None])], "id long, features array<double>")
    with pytest.raises(Exception, match="null or NaN"):
        write_placed_points(bad, path)
    assert read_placed_points(spark, path).count() == 2_000  # the old rows stay
