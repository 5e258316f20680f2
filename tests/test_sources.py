import pytest
from pyspark.sql import functions as F

from pointcluster import compare_centroids, fit_minmax, run_metrics
from pointcluster.operators.nearest import centroid_frame
from pointcluster.sources import tables, trips


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text(
        "vendor,id,passenger_count,pickup_latitude,pickup_longitude,pickup_datetime,note\n"
        "2,id1,1,40.76,-73.98,2016-03-14 17:24:55,x\n"
        "1,id2,,40.70,-74.00,2016-03-14 18:00:00,y\n"
    )
    rows = trips.read_trips(spark, str(path)).orderBy("id").collect()
    assert rows[0]["pickup_longitude"] == -73.98 and rows[0]["passenger_count"] == 1
    assert rows[1]["passenger_count"] is None
    assert rows[0]["pickup_datetime"].hour == 17
    few = trips.read_trips(spark, str(path), columns=["id", "pickup_latitude"])
    assert few.columns == ["id", "pickup_latitude"]
    inferred = trips.read_trips(spark, str(path), infer_schema=True)
    assert dict(inferred.dtypes)["pickup_latitude"] == "double"


def test_csv_without_a_needed_column(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,pickup_latitude\n1,40.7\n")
    with pytest.raises(ValueError):
        trips.read_trips(spark, str(path))


def test_points_and_scaler(make_points, spark, tmp_path):
    points = make_points([(0.1, 0.2), (1 / 3, 2 / 3)])
    for _ in range(2):  # the second write replaces the first
        tables.write_points(points, str(tmp_path / "p"))
    back = tables.read_points(spark, str(tmp_path / "p"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, points.collect()))
    scaler = fit_minmax(points)
    tables.write_scaler(scaler, str(tmp_path / "s"))
    assert tables.read_scaler(spark, str(tmp_path / "s")).collect() == scaler.collect()


def test_missing_rows_are_errors(spark, tmp_path):
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], tables.SCALER_SCHEMA).write.json(empty)
    with pytest.raises(ValueError):
        tables.read_scaler(spark, empty)
    with pytest.raises(ValueError):
        tables.read_centroids(spark, empty)


# Two centroids as stored by an earlier run.
STORED = [
    '{"cluster_id":1,"centroid":"[0.46739720441674487, 0.566414754901537]"}',
    '{"cluster_id":0,"centroid":"[0.6841135905387657, 0.6694345887547155]"}',
]


def test_stored_centroids_are_read_in_id_order(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "part-0.json").write_text("\n".join(STORED) + "\n")
    rows = tables.read_centroids(spark, str(folder)).collect()
    assert [r["cluster_id"] for r in rows] == [0, 1]
    assert rows[1]["centroid"] == [0.46739720441674487, 0.566414754901537]
    tables.write_centroids(tables.read_centroids(spark, str(folder)), str(tmp_path / "d"))
    assert tables.read_centroids(spark, str(tmp_path / "d")).collect() == rows


def test_labels_are_normalised(spark, tmp_path):
    spark.createDataFrame([(7, 1)], "point_id long, cluster_id long").write.parquet(
        str(tmp_path / "l")
    )
    assert tables.read_labels(spark, str(tmp_path / "l")).first() == ("7", 1)
    assert tables.read_labels(spark, str(tmp_path / "l"), "string").first() == ("7", "1")


def test_metrics_roundtrip(spark, tmp_path):
    labels = spark.createDataFrame([(0,), (0,), (2,)], "cluster_id int")
    row = run_metrics(labels, "lloyd", 3, 20, 1e-4, 42, "seeded", 1.5)
    tables.write_metrics(row, str(tmp_path / "m"))
    back = tables.read_metrics(spark, str(tmp_path / "m")).first()
    assert back["cluster_sizes"] == '[{"cluster_id":0,"count":2},{"cluster_id":2,"count":1}]'
    assert back["silhouette_score"] is None and back["limit"] is None
    assert back["tol"] == 1e-4 and back["test_mode"] is False


def test_comparison_aligns_sets_of_different_ids(spark, make_points):
    a = centroid_frame(spark, [[0.1234567, 0.5], [1.0, 1.0]])
    b = centroid_frame(spark, [[0.25, 0.75]], ids=[1])
    scaler = fit_minmax(make_points([(0, 10), (4, 30)]))
    rows = {r["cluster"]: r for r in compare_centroids({"a": a, "b": b}, scaler).collect()}
    assert rows["cluster_0"]["a_scaled"] == [0.123457, 0.5]
    assert rows["cluster_0"]["b_scaled"] is None
    assert rows["cluster_1"]["b"] == [1.0, 25.0]


def test_files_of_another_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "trips"
    folder.mkdir()
    head = "id,pickup_datetime,{},passenger_count"
    (folder / "a.csv").write_text(
        head.format("pickup_longitude,pickup_latitude") + "\n1,2016-01-01 00:00:00,-73.9,40.7,1\n"
    )
    (folder / "b.csv").write_text(
        head.format("pickup_latitude,pickup_longitude") + "\n2,2016-01-01 00:00:00,40.7,-73.9,1\n"
    )
    with pytest.raises(Exception, match="header does not conform"):
        trips.read_trips(spark, str(folder)).collect()
    for name in "ab":
        row = trips.read_trips(spark, str(folder / f"{name}.csv")).first()
        assert (row["pickup_longitude"], row["pickup_latitude"]) == (-73.9, 40.7)
