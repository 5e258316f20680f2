"""Sinks replace a table only by a complete one."""

import os

import pytest
from pyspark.sql import functions as F

from pointcluster.functions.durable import recover, replace
from pointcluster.sources import tables


def ids(spark, path):
    return sorted(r["id"] for r in tables.read_points(spark, path).collect())


def test_failed_write_leaves_the_old_rows(spark, make_points, tmp_path):
    path = str(tmp_path / "points")
    tables.write_points(make_points([(float(i), 0.0) for i in range(50)]), path)
    broken = make_points([(float(i), 1.0) for i in range(50)], parts=5).withColumn(
        "id", F.expr("IF(id = 40, CAST(raise_error('killed half-way') AS BIGINT), id + 1000)")
    )
    with pytest.raises(Exception, match="killed half-way"):
        tables.write_points(broken, path)
    assert ids(spark, path) == list(range(50)) and os.listdir(tmp_path) == ["points"]


def test_a_table_is_replaced_by_what_is_read_from_it(spark, make_points, tmp_path):
    path = str(tmp_path / "points")
    tables.write_points(make_points([(float(i), 0.0) for i in range(20)]), path)
    for _ in range(2):
        stored = tables.read_points(spark, path)
        tables.write_points(stored.withColumn("id", F.col("id") + 1), path)
    assert ids(spark, path) == list(range(2, 22)) and os.listdir(tmp_path) == ["points"]
    tables.write_points(stored.limit(0), path)
    assert ids(spark, path) == []


def test_a_switch_cut_off_between_renames_is_recovered(spark, make_points, tmp_path):
    path = str(tmp_path / "points")
    tables.write_points(make_points([(1.0, 1.0)]), path)
    assert not recover(spark, path)
    os.rename(path, f"{path}.old-1")  # as a driver that dies then would leave it
    assert recover(spark, path) and ids(spark, path) == [0]
    with pytest.raises(ZeroDivisionError):
        replace(spark, path, lambda staged: 1 / 0)
    assert ids(spark, path) == [0]
