"""Headline timings: one JSON line on stdout.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores.
Inputs are the events table as trips (100,000 rows at sf0.1). Each entry is the
wall time of the whole query with its result collected or counted. With
BENCH_GROWTH=1,3,10 it prints seconds over 1, 3 and 10 copies of the table instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pointcluster import (  # noqa: E402
    assign_nearest,
    connected_components,
    dbscan,
    elkan_kmeans,
    eps_neighbors,
    kmeans,
    seeded_sample,
    silhouette_euclid,
    silhouette_sq,
)
from pointcluster import queries  # noqa: E402
from pointcluster.plans.mlkmeans import ml_kmeans  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pointcluster-bench")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def history(run) -> dict:
    """Rounds, seconds per round after the first, and distances computed."""
    seconds = [r[3] for r in run.history_rows]
    later = seconds[1:] or seconds
    return {
        "rounds": len(seconds),
        "sec_per_round": round(sum(later) / len(later), 4),
        "n_dist": sum(r[2] for r in run.history_rows),
    }


def grown(points, times: int, crowded: bool):
    """``times`` copies of the points under new ids, moved by a small fixed jitter; crowded:
    a third of all points drawn into one spot of a ten-thousandth of the range."""
    jitter = [f"(pmod(xxhash64(id, copy, {i}), 2000) / 1000 - 1) / 100" for i in range(2)]
    spread = points.selectExpr("id", "features", f"explode(sequence(0L, {times} - 1L)) AS copy")
    x = [f"features[{i}] + {j}" for i, j in enumerate(jitter)]
    if crowded:
        x = [f"IF(id % 3 = 0, 0.5D + {j} / 100, {v})" for v, j in zip(x, jitter)]
    made = spread.selectExpr("id * 1000 + copy AS id", f"array({x[0]}, {x[1]}) AS features")
    return made.withMetadata("features", {"dimension": 2})


def growth(spark) -> dict:
    """Seconds by number of points (BENCH_GROWTH: copies of the table, comma-separated)."""
    points = queries.trip_points(spark, SF_DIR)
    n, out = points.count(), {}
    for times in map(int, os.environ["BENCH_GROWTH"].split(",")):
        for crowded in (False, True):
            held = grown(points, times, crowded).repartition(2 * int(CPUS)).persist()
            held.count()
            # the radius shrinks with the density, so that the pairs grow with the points
            eps = 0.002 / times**0.5
            work = {
                "lloyd_k11_10_rounds": lambda: kmeans(held, 11, 10, 0.0),
                "sample_half": lambda: seeded_sample(held, n * times // 2).count(),
                "dbscan_min10": lambda: dbscan(held, eps * 3, 10).count(),
            }
            if not crowded:  # a third of all points as one clique has no bounded pair list
                work["eps_neighbors"] = lambda: eps_neighbors(held, eps).count()
                work["components"] = lambda: connected_components(
                    eps_neighbors(held, eps / 2).where("id < neighbor_id").selectExpr(
                        "id AS src", "neighbor_id AS dst")).labels.count()
            for name, run in work.items():
                started = time.perf_counter()
                run()
                seconds = round(time.perf_counter() - started, 2)
                key = f"{name}{'_crowded' if crowded else ''}"
                out.setdefault(key, {})[str(n * times)] = seconds
                print(key, n * times, seconds, file=sys.stderr, flush=True)
            held.unpersist()
    return out


def main() -> None:
    spark = session()
    if os.environ.get("BENCH_GROWTH"):
        print(json.dumps({"metric": "growth_seconds", "growth": growth(spark), "cpus": CPUS}))
        spark.stop()
        return
    seconds: dict[str, float] = {}
    detail: dict[str, dict] = {}

    def timed(name, work):
        started = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    n_points = events.count()
    events.groupBy("event_type").count().collect()  # start the executor threads

    timed("preprocess", lambda: queries.minmax_scale(spark, SF_DIR).write.format("noop").mode(
        "overwrite").save())
    points = queries.trip_points(spark, SF_DIR)
    for k in (5, 11):
        for name, fit in (("lloyd", kmeans), ("elkan", elkan_kmeans)):
            key = f"{name}_k{k}"
            detail[key] = history(timed(key, lambda: fit(points, k, 10, 0.0)))
    timed("ml_kmeans_k11", lambda: ml_kmeans(points, 11, 10, 0.0).centroids.collect())
    start = kmeans(points, 11, 1, 0.0).centroids
    timed("score", lambda: assign_nearest(points, start).write.format("noop").mode(
        "overwrite").save())
    detail["score"] = {"rows_per_sec": round(n_points / seconds["score"])}
    labelled = assign_nearest(points, start)
    timed("silhouette_sq", lambda: silhouette_sq(labelled).collect())
    timed("silhouette_euclid_20k", lambda: silhouette_euclid(labelled, "lloyd", 20_000).collect())
    timed("eps_neighbors", lambda: eps_neighbors(points, 0.002).count())
    timed("dbscan_eps0.02_min20", lambda: dbscan(points, 0.02, 20).count())
    timed("dbscan_eps0.005_min10", lambda: dbscan(points, 0.005, 10).count())
    timed("components", lambda: queries.components(spark, SF_DIR).count())
    timed("flagship", lambda: queries.flagship(spark, SF_DIR).collect())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "points": n_points,
                "cpus": CPUS,
                "detail": detail,
            }
        )
    )


if __name__ == "__main__":
    main()
