import datetime as dt

import pytest
from pyspark.sql import functions as F

from pointcluster.operators import sample

from pointcluster import (
    assemble,
    filter_box,
    fit_minmax,
    inverse_scale,
    limit_points,
    raw_limit,
    scale,
    seeded_sample,
    with_hour,
)

TRIP = "id string, pickup_longitude double, pickup_latitude double, passenger_count int"


def test_box_is_strict_and_drops_nulls(spark):
    rows = [
        ("in", -74.0, 40.7, 1),
        ("left", -74.25, 40.7, 1),
        ("right", -73.7, 40.7, 1),
        ("low", -74.0, 40.5, 1),
        ("high", -74.0, 40.9, 1),
        ("nobody", -74.0, 40.7, 0),
        ("null lon", None, 40.7, 1),
        ("null lat", -74.0, None, 1),
        ("null count", -74.0, 40.7, None),
    ]
    kept = filter_box(spark.createDataFrame(rows, TRIP))
    assert [r["id"] for r in kept.collect()] == ["in"]


def test_box_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame([("a", -74.0, 40.7, 1)], TRIP).write.parquet(path)
    plan = filter_box(spark.read.parquet(path)).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pickup_longitude)" in text


def test_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 3, 14, 17, 24, 55),)], "t timestamp_ntz")
    assert with_hour(df, "t").first()["pickup_hour"] == 17


def test_scaling_and_inverse(make_points):
    points = make_points([(0, 5), (1, 5), (4, 5)])
    scaler = fit_minmax(points)
    scaled = {r["id"]: r["features"] for r in scale(points, scaler).collect()}
    assert scaled == {0: [0.0, 0.0], 1: [0.25, 0.0], 2: [1.0, 0.0]}
    back = {r["id"]: r["features"] for r in inverse_scale(scale(points, scaler), scaler).collect()}
    assert back == {0: [0.0, 5.0], 1: [1.0, 5.0], 2: [4.0, 5.0]}


def test_saved_bounds_may_leave_the_unit_box(make_points):
    scaler = fit_minmax(make_points([(0, 0), (2, 2)]))
    out = scale(make_points([(4, -2)]), scaler).first()["features"]
    assert out == [2.0, -1.0]


def test_empty_input_is_refused(make_points):
    with pytest.raises(ValueError):
        fit_minmax(make_points([(1, 1)]).where("id < 0"))


def test_fit_reads_only_the_feature_columns(spark, trips_dir):
    events = spark.read.parquet(f"{trips_dir}/events.parquet")
    points = assemble(events, "event_id", ["value", "user_id"])
    plan = points.selectExpr("min(features[0])")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "props" not in text and "event_type" not in text


@pytest.mark.parametrize("n", [0, -3])
def test_limit_must_be_positive(make_points, n):
    with pytest.raises(ValueError):
        limit_points(make_points([(1, 1)]), n)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_limits_follow_the_id(make_points):
    points = make_points([(i, i) for i in range(500)], parts=7)
    assert ids(limit_points(points, 100)) == list(range(100))
    assert ids(limit_points(points, 100, top_rows=1)) == list(range(100))
    assert ids(limit_points(points, 5000, top_rows=1)) == list(range(500))
    assert ids(limit_points(points, None)) == list(range(500))
    assert ids(raw_limit(points, 3, "id")) == [0, 1, 2]


@pytest.mark.parametrize("band,keys", [(10, 400), (900, 200)])
def test_nth_key_narrows_over_several_rounds(make_points, monkeypatch, band, keys):
    monkeypatch.setattr(sample, "BAND_ROWS", band)
    monkeypatch.setattr(sample, "SAMPLE_KEYS", keys)
    points = make_points({f"k{i:05d}": (i, i) for i in range(2000)}, parts=5)
    for n in (3, 777, 2000):
        assert ids(limit_points(points, n, top_rows=1)) == [f"k{i:05d}" for i in range(min(n, 2000))]
    values = [i * i - 400 for i in range(300)]
    points = make_points({v: (v, v) for v in values}, parts=4)
    for n in (1, 123, 299, 300, 301):
        assert ids(limit_points(points, n, top_rows=0)) == values[:n]


def test_digest_bounds(make_points, monkeypatch):
    monkeypatch.setattr(sample, "BAND_ROWS", 5)
    monkeypatch.setattr(sample, "SAMPLE_KEYS", 300)
    points = make_points([(i, i) for i in range(3000)], parts=4)
    whole = {n: ids(points.orderBy(*sample.sample_order(3)).limit(n)) for n in (1, 90, 1500, 2990)}
    for n, want in whole.items():
        assert ids(seeded_sample(points, n, 3, top_rows=0)) == want


def test_limits_take_few_jobs(spark, make_points):
    """Counting, enclosing and ordering the band: no more scans than that."""
    points = make_points({f"k{i:05d}": (i, i) for i in range(3000)}, parts=5).cache()
    points.count()
    context = spark.sparkContext
    for name, work in (
        ("sample", lambda: seeded_sample(points, 1000, 3)),
        ("limit", lambda: limit_points(points, 1000)),
    ):
        context.setJobGroup(name, name)
        work()
        assert len(context.statusTracker().getJobIdsForGroup(name)) <= 5, name
    context.setLocalProperty("spark.jobGroup.id", None)
    points.unpersist()


def test_raw_limit_needs_an_order(make_points):
    with pytest.raises(ValueError):
        raw_limit(make_points([(1, 1)]), 3)


def test_sample_is_exact_and_repeats(make_points):
    from hashlib import md5

    rows = [(i, i) for i in range(300)]
    want = sorted(range(300), key=lambda i: md5(f"7:{i}".encode()).hexdigest())
    for parts in (1, 6):
        points = make_points(rows, parts)
        assert ids(seeded_sample(points, 40, 7)) == sorted(want[:40])
        assert ids(seeded_sample(points, 40, 7, top_rows=1)) == sorted(want[:40])
        assert ids(seeded_sample(points, 900, 7)) == list(range(300))


@pytest.mark.parametrize("n", [95, 100, 101, 105, 150, 199, 200, 300])
def test_exact_numbers_where_keys_repeat(spark, n):
    """200 rows, each id ten times; of each id five rows are the same throughout."""
    rows = spark.range(200, numPartitions=5).selectExpr(
        "id % 20 AS id", "IF(id % 40 < 20, 1L, id) AS v", "id AS _k0", "'x' AS _p"
    ).drop("_k0").withColumn("_k1", F.lit(0))
    from pointcluster.operators.sample import limit_points, raw_limit, seeded_sample

    for found in (raw_limit(rows, n, "id"), limit_points(rows, n), seeded_sample(rows, n)):
        assert found.columns == rows.columns
        got = [tuple(r) for r in found.collect()]
        assert len(got) == min(n, 200)
        left = list(map(tuple, rows.collect()))
        for row in got:
            left.remove(row)  # no row more often than it is there
    ids = sorted(r["id"] for r in limit_points(rows, n).collect())
    assert ids == sorted(i for i in range(20) for _ in range(10))[:n]
    again = raw_limit(rows.repartition(3), n, "id").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, raw_limit(rows, n, "id").collect()))


def test_nearest_with_clashing_columns_and_odd_ids(spark, make_points):
    from pointcluster import assign_nearest
    from pointcluster.operators.nearest import centroid_frame

    points = make_points([(float(i), 0.0) for i in range(30)])
    for k, step in ((3, 7), (40, 5)):
        centers = [(float(i), 0.0) for i in range(k)]
        ids = [9 + step * i for i in range(k)]
        clash = points.selectExpr("*", *[f"id AS {c}" for c in ("c", "f0", "f1", "d2", "_d0", "_n", "_p")])
        got = assign_nearest(clash, centroid_frame(spark, centers, ids)).collect()
        assert {r["id"]: r["cluster_id"] for r in got} == {i: ids[min(i, k - 1)] for i in range(30)}
        assert all(r["c"] == r["f0"] == r["_p"] == r["id"] for r in got)
    with pytest.raises(ValueError, match="dist_sq"):
        assign_nearest(points.selectExpr("*", "1 AS dist_sq"), centroid_frame(spark, [(0.0, 0.0)]))
