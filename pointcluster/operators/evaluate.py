"""Sizes, top clusters, inertia, silhouettes, comparison and run metrics."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.durable import Workspace
from ..functions.exprs import dimension, feature_block, feature_names, lit, unpack, unrolls
from .joins import balanced_join
from .nearest import centroid_list
from .prepare import inverse_scale
from .sample import seeded_sample

# Up to so many clusters their statistics are part of the plan; more of them meet
# the points block by block.
SCORE_CLUSTERS = 4_096
SCORE_ROWS = 100_000
# Rows per block of a Euclidean silhouette: a task compares two blocks.
SAMPLE_BLOCK = 4_096
UNKNOWN_LABEL = "label without a centroid"


def cluster_sizes(labels: DataFrame) -> DataFrame:
    return (
        labels.groupBy("cluster_id").agg(F.count("*").alias("count")).orderBy("cluster_id")
    )


def top_clusters(labels: DataFrame, n: int) -> DataFrame:
    """The n largest clusters; the lower id wins a tie."""
    counts = labels.groupBy("cluster_id").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "cluster_id").limit(n)


def in_top_clusters(labels: DataFrame, n: int) -> DataFrame:
    """Rows whose cluster is one of the n largest."""
    top = top_clusters(labels, n).select("cluster_id")
    # n ids at most, the caller's own bound
    top = F.broadcast(top) if n <= 10_000 else top
    return labels.join(top, "cluster_id", "left_semi")


def without_noise(labels: DataFrame, noise="-1") -> DataFrame:
    return labels.where(F.col("cluster_id") != F.lit(noise))


def distinct_clusters(labels: DataFrame) -> DataFrame:
    return labels.agg(F.countDistinct("cluster_id").alias("n_clusters"))


def noise_summary(labels: DataFrame, noise="-1") -> DataFrame:
    """Points, noise points and clusters (noise is not a cluster)."""
    is_noise = F.col("cluster_id") == F.lit(noise)
    per_cluster = labels.groupBy("cluster_id").agg(F.count("*").alias("n"))
    return per_cluster.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_points"),
        F.coalesce(F.sum(F.when(is_noise, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.count(F.when(~is_noise, True)).alias("n_clusters"),
    )


def join_labels(points: DataFrame, labels: DataFrame, id_column: str = "id") -> DataFrame:
    """Points with their label; points without one drop out. Ids are unique."""
    same = points[id_column].cast("string") == labels["point_id"]
    return points.join(labels, same, "inner").drop(labels["point_id"])


def label_overlap(memberships: DataFrame) -> DataFrame:
    """Points carrying more than one label: ``(point_id, labels)``.

    Distinct memberships first, so a label repeated for one point is reduced
    before the shuffle.
    """
    return (
        memberships.select("point_id", "cluster_id")
        .distinct()
        .groupBy("point_id")
        .agg(F.sort_array(F.collect_set("cluster_id")).alias("labels"))
        .where(F.size("labels") > 1)
    )


def inertia(labelled: DataFrame, centroids: DataFrame) -> DataFrame:
    """Sum of squared distances to the assigned centroid (training cost).

    ``labelled`` is ``(features, cluster_id)``. The centroids are part of the
    plan, so no join with them is needed. A label without a centroid is an error.
    """
    ids, centers = centroid_list(centroids)
    d = len(centers[0])
    names = feature_names(d)
    if unrolls(len(ids), d):
        flat = unpack(labelled, d, "cluster_id")
        cost = "CASE " + " ".join(
            f"WHEN cluster_id = {j} THEN "
            + " + ".join(f"({n} - {lit(v)}) * ({n} - {lit(v)})" for n, v in zip(names, c))
            for j, c in zip(ids, centers)
        )
        unknown = f"CAST(raise_error('{UNKNOWN_LABEL}') AS DOUBLE)"
        return flat.selectExpr(f"{cost} ELSE {unknown} END AS cost").agg(
            F.sum("cost").alias("inertia")
        )
    known, table = np.array(ids), np.array(centers)

    @F.pandas_udf("double")
    def cost_of(features: pd.Series, cluster: pd.Series) -> pd.Series:
        x = feature_block(features, d)
        if cluster.isna().any():
            raise ValueError(UNKNOWN_LABEL)
        at = np.minimum(np.searchsorted(known, cluster.to_numpy()), len(known) - 1)
        if (known[at] != cluster.to_numpy()).any():
            raise ValueError(UNKNOWN_LABEL)
        return pd.Series(((x - table[at]) ** 2).sum(axis=1))

    return labelled.select(cost_of("features", "cluster_id").alias("cost")).agg(
        F.sum("cost").alias("inertia")
    )


def silhouette_sq(labelled: DataFrame) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, over all points.

    One aggregate yields count, sum and squared norm per cluster; each point
    is then scored against those k rows alone. A one-point cluster scores 0.
    """
    d = dimension(labelled)
    names = feature_names(d)
    flat = unpack(labelled, d, "cluster_id")
    # around the mean the squares stay small, however far off the data lie
    middle = flat.agg(*[F.avg(n).alias(n) for n in names]).first()
    if middle[0] is None:
        return _score_row(labelled, float("nan"))
    flat = flat.selectExpr("cluster_id", *[f"{n} - {lit(middle[n])} AS {n}" for n in names])
    norm = " + ".join(f"{n} * {n}" for n in names)
    stats = flat.groupBy("cluster_id").agg(
        F.count("*").alias("n"),
        F.expr(f"sum({norm})").alias("q"),
        *[F.sum(n).alias(f"s{i}") for i, n in enumerate(names)],
    )
    rows = stats.limit(SCORE_CLUSTERS + 1).collect()
    k = len(rows)
    if k < 2:
        return _score_row(labelled, float("nan"))
    rows.sort(key=lambda r: r["cluster_id"])
    if k > SCORE_CLUSTERS:
        return _silhouette_tables(labelled, flat, stats, names)
    if unrolls(k, d):
        scored = _silhouette_columns(flat, rows, names, norm)
    else:
        scored = _silhouette_blocks(flat, rows, names)
    return scored.agg(F.avg("s").alias("silhouette"))


def _score_row(df: DataFrame, value: float | None) -> DataFrame:
    return df.sparkSession.createDataFrame([(value,)], "silhouette double")


def _silhouette_columns(flat, stats, names, norm):
    """Mean squared distance to cluster c: |x|^2 - 2 x.mean + mean sq norm."""

    def mean_dist(r, n):
        dot = " + ".join(f"{f} * {lit(2 * r[f's{i}'] / n)}" for i, f in enumerate(names))
        return f"_x - ({dot}) + {lit(r['q'] / n)}"

    place = {r["cluster_id"]: j for j, r in enumerate(stats)}
    own_place = F.lit(None).cast("int")
    for value, j in place.items():
        own_place = F.when(F.col("cluster_id") == F.lit(value), j).otherwise(own_place)

    def label(r):
        return str(place[r["cluster_id"]])

    own = []
    for r in stats:
        if r["n"] == 1:
            continue
        n = r["n"]
        whole = f"({mean_dist(r, n)}) * {lit(n / (n - 1))}"
        own.append(f"WHEN _own = {label(r)} THEN {whole}")
    a = f"CASE {' '.join(own)} END" if own else "CAST(NULL AS DOUBLE)"
    others = ", ".join(
        f"IF(_own = {label(r)}, NULL, {mean_dist(r, r['n'])})" for r in stats
    )
    return (
        flat.withColumn("_own", own_place).selectExpr("*", f"{norm} AS _x")
        .selectExpr(f"{a} AS a", f"least({others}) AS b")
        .selectExpr(
            "CASE WHEN a IS NULL THEN 0D WHEN greatest(a, b) = 0 THEN 0D "
            "ELSE (b - a) / greatest(a, b) END AS s"
        )
    )


def _mean_dists(x: np.ndarray, n: np.ndarray, q: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Mean squared distance of each row to each cluster, by one matrix product."""
    return (x * x).sum(axis=1)[:, None] - 2.0 * (x @ (sums / n[:, None]).T) + q / n


def _sq_scores(a: np.ndarray, b: np.ndarray, alone: np.ndarray) -> np.ndarray:
    top = np.maximum(a, b)
    good = ~alone & (top != 0)
    return np.where(good, (b - a) / np.where(good, top, 1), 0.0)


def _silhouette_blocks(flat, stats, names):
    ids = [r["cluster_id"] for r in stats]
    position = {v: j for j, v in enumerate(ids)}
    n = np.array([r["n"] for r in stats], dtype=float)
    sums = np.array([[r[f"s{i}"] for i in range(len(names))] for r in stats])
    q = np.array([r["q"] for r in stats])
    strip = max(1, 4_000_000 // len(ids))

    def score(batches):
        for batch in batches:
            for at in range(0, len(batch), strip):
                part = batch.iloc[at : at + strip]
                own = part["cluster_id"].map(position).to_numpy()
                dist = _mean_dists(part[names].to_numpy(dtype=float), n, q, sums)
                each = np.arange(len(part))
                a = dist[each, own] * n[own] / np.maximum(n[own] - 1, 1)
                dist[each, own] = np.inf
                yield pd.DataFrame({"s": _sq_scores(a, dist.min(axis=1), n[own] == 1)})

    return flat.mapInPandas(score, "s double")


def _silhouette_tables(labelled, flat, stats, names):
    """As ``_silhouette_blocks`` for any number of clusters: parts of the points
    meet blocks of cluster statistics, and the least distances are combined."""
    spark = labelled.sparkSession
    work = Workspace(spark)
    try:
        rows = work.store(flat.withColumn("rid", F.monotonically_increasing_id()))
        stats = work.store(stats)
        blocks = -(-stats.count() // SCORE_CLUSTERS)
        parts = -(-rows.count() // SCORE_ROWS)
        x = rows.selectExpr(
            "*", f"pmod(xxhash64(rid), {parts}) AS part",
            f"explode(sequence(0, {blocks} - 1)) AS block",
        )
        y = stats.selectExpr(
            "*", f"CAST(pmod(xxhash64(cluster_id), {blocks}) AS int) AS block",
            f"explode(sequence(0L, {parts} - 1L)) AS part",
        )

        def score(x, y):
            if not len(x) or not len(y):
                return pd.DataFrame({"rid": [], "a": [], "b": [], "n": []})
            n, q = y["n"].to_numpy(dtype=float), y["q"].to_numpy()
            sums = y[[f"s{i}" for i in range(len(names))]].to_numpy()
            place = {v: j for j, v in enumerate(y["cluster_id"])}
            out = []
            strip = max(1, 4_000_000 // len(y))
            for at in range(0, len(x), strip):
                part = x.iloc[at : at + strip]
                dist = _mean_dists(part[names].to_numpy(dtype=float), n, q, sums)
                own = part["cluster_id"].map(place).to_numpy(dtype=float)
                here = np.flatnonzero(~np.isnan(own))
                j = own[here].astype(int)
                a, size = np.full(len(part), np.nan), np.full(len(part), np.nan)
                a[here] = dist[here, j] * n[j] / np.maximum(n[j] - 1, 1)
                size[here] = n[j]
                dist[here, j] = np.inf
                out.append(pd.DataFrame(
                    {"rid": part["rid"].to_numpy(), "a": a, "b": dist.min(axis=1), "n": size}
                ))
            return pd.concat(out)

        met = x.groupBy("part", "block").cogroup(y.groupBy("part", "block")).applyInPandas(
            score, "rid long, a double, b double, n double"
        )
        whole = met.groupBy("rid").agg(
            F.max(F.expr("IF(isnan(a), NULL, a)")).alias("a"), F.min("b").alias("b"),
            F.max(F.expr("IF(isnan(n), NULL, n)")).alias("n"),
        )
        value = whole.selectExpr(
            "avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0D ELSE (b - a) / greatest(a, b) END)"
        ).first()[0]
        return _score_row(labelled, value)
    finally:
        work.close()


def silhouette_euclid(
    labelled: DataFrame, algorithm: str, sample_size: int = 100_000, seed: int = 42
) -> DataFrame:
    """Mean Euclidean silhouette of a seeded sample.

    One row ``(algorithm, k, n_points, silhouette_sample_size,
    silhouette_score)``; NaN with fewer than two labels. The sample is cut into
    blocks, and a task sums the distances between two of them: clusters larger
    than a block are spread over blocks of their own, the others lie whole in
    one, so a task holds two blocks whatever the sample and the clusters.
    """
    if sample_size <= 0:
        raise ValueError("sample_size must be a positive integer")
    spark = labelled.sparkSession
    d = dimension(labelled)
    counts = labelled.groupBy("cluster_id").agg(F.count("*").alias("n"))
    totals = counts.agg(F.count("*").alias("k"), F.sum("n").alias("n")).first()
    k, n = int(totals["k"]), int(totals["n"] or 0)
    size = min(sample_size, n)
    work = Workspace(spark)
    try:
        score = _euclid_score(labelled, d, size, seed, work) if k > 1 else float("nan")
    finally:
        work.close()
    return spark.createDataFrame(
        [(algorithm, k, n, size, score)],
        "algorithm string, k int, n_points long, silhouette_sample_size long, "
        "silhouette_score double",
    )


def _euclid_score(labelled: DataFrame, d: int, size: int, seed: int, work: Workspace) -> float:
    names = feature_names(d)
    sample = unpack(seeded_sample(labelled, size, seed), d, "cluster_id")
    sample = work.store(sample.withColumn("rid", F.monotonically_increasing_id()))
    members = work.store(sample.groupBy("cluster_id").agg(F.count("*").alias("m")))
    n_labels = members.count()
    if n_labels < 2:
        return float("nan")
    blocks = -(-size // SAMPLE_BLOCK)
    sized = balanced_join(sample, members, ["cluster_id"], n_labels)
    # a large cluster has blocks of its own, small ones share a block whole
    placed = work.store(sized.selectExpr(
        "*",
        f"m > {SAMPLE_BLOCK} AS large",
        f"IF(m > {SAMPLE_BLOCK}, pmod(xxhash64(cluster_id, "
        f"pmod(xxhash64(rid), m DIV {SAMPLE_BLOCK} + 1)), 1000000007), "
        f"-1 - pmod(xxhash64(cluster_id), {blocks})) AS block",
    ))
    ids = placed.select("block").distinct()
    ids = F.broadcast(ids.agg(F.collect_list("block").alias("all")))  # a few per block of rows
    one = placed.withColumn("one", F.lit(1))
    spread = one.join(ids.withColumn("one", F.lit(1)), "one").drop("one")
    x = spread.select("rid", "cluster_id", "m", *names, F.col("block").alias("i"), F.explode("all").alias("j"))
    y = spread.select(
        *[F.col(c).alias(f"y_{c}") for c in ("cluster_id", "m", "large", *names)],
        F.col("block").alias("j"),
        F.explode("all").alias("i"),
    )

    def sums(x, y):
        """Per row of x: the sum to a large cluster, or the least mean among small ones."""
        y = y.rename(columns=lambda c: c.removeprefix("y_"))
        codes, labels = pd.factorize(y["cluster_id"])
        order = np.argsort(codes, kind="stable")
        py = y[names].to_numpy(dtype=float)[order]
        starts = np.searchsorted(codes[order], np.arange(len(labels)))
        m = y["m"].to_numpy(dtype=float)[order][starts]
        large = y["large"].to_numpy()[order][starts]
        place = {v: j for j, v in enumerate(labels)}
        px = x[names].to_numpy(dtype=float)
        own = x["cluster_id"].map(place).fillna(-1).to_numpy(dtype=int)
        out = []
        strip = max(1, 2_000_000 // max(len(py), 1))
        for at in range(0, len(px), strip):
            some, mine = px[at : at + strip], own[at : at + strip]
            d2 = np.zeros((len(some), len(py)))
            for i in range(d):
                d2 += (some[:, i][:, None] - py[None, :, i]) ** 2
            total = np.add.reduceat(np.sqrt(d2), starts, axis=1)
            rid = x["rid"].to_numpy()[at : at + strip]
            for j in np.flatnonzero(large):
                out.append(pd.DataFrame({
                    "rid": rid, "label": str(labels[j]), "own": mine == j, "s": total[:, j],
                    "m": m[j],
                }))
            small = np.flatnonzero(~large)
            if len(small):
                mean = total / m
                here = np.flatnonzero((mine >= 0) & ~large[np.maximum(mine, 0)])
                out.append(pd.DataFrame({
                    "rid": rid[here], "label": "", "own": True, "s": total[here, mine[here]],
                    "m": m[mine[here]],
                }))
                mean[:, large] = np.inf
                mean[here, mine[here]] = np.inf
                least = mean.min(axis=1)
                there = np.isfinite(least)
                out.append(pd.DataFrame({
                    "rid": rid[there], "label": "", "own": False, "s": least[there], "m": 1.0,
                }))
        return pd.concat(out) if out else pd.DataFrame(
            {"rid": [], "label": [], "own": [], "s": [], "m": []}
        )

    met = x.groupBy("i", "j").cogroup(y.groupBy("i", "j")).applyInPandas(
        sums, "rid long, label string, own boolean, s double, m double"
    )
    # blocks of one large cluster add up; rows of small ones are final
    added = met.groupBy("rid", "label", "own", F.expr("IF(label = '', s, 0D)").alias("single")).agg(
        F.sum("s").alias("s"), F.max("m").alias("m"), F.count("*").alias("c")
    )
    added = added.withColumn("s", F.expr("IF(label = '', single, s)"))
    each = added.groupBy("rid").agg(
        F.max(F.expr("IF(own AND m > 1, s / (m - 1), NULL)")).alias("a"),
        F.min(F.expr("IF(own, NULL, s / m)")).alias("b"),
    )
    return each.selectExpr(
        "avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0D ELSE (b - a) / greatest(a, b) END)"
    ).first()[0]


def compare_centroids(
    sets: Mapping[str, DataFrame], scaler: DataFrame | None = None, places: int = 6
) -> DataFrame:
    """Centroid sets side by side, one row per ``cluster_<id>``.

    Columns ``<name>_scaled`` hold the stored position; with a scaler,
    ``<name>`` holds it in the original units. Centroid rows only.
    """
    table = None
    for name, centroids in sets.items():
        named = centroids.select(
            F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string")).alias("cluster"),
            F.col("centroid").alias("features"),
        )
        column = named.select("cluster", _rounded(places).alias(f"{name}_scaled"))
        table = column if table is None else table.join(column, "cluster", "full_outer")
    if scaler is not None:
        for name, centroids in sets.items():
            raw = inverse_scale(
                centroids.select(
                    F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string")).alias(
                        "cluster"
                    ),
                    F.col("centroid").alias("features"),
                ),
                scaler,
            )
            column = raw.select("cluster", _rounded(places).alias(name))
            table = table.join(column, "cluster", "full_outer")
    return table


def _rounded(places: int):
    return F.transform("features", lambda v: F.round(v, places))


def run_metrics(
    labels: DataFrame,
    algorithm: str,
    k: int,
    max_iterations: int,
    tol: float,
    seed: int,
    init_mode: str,
    training_cost: float,
    silhouette_score: float | None = None,
    limit: int | None = None,
    test_mode: bool = False,
) -> DataFrame:
    """One row describing a run; sizes as an array of (cluster_id, count), ordered by id.

    The row holds all clusters: it is for runs whose clusters are few enough to read. Labels
    of any type are kept as they are, strings of DBSCAN too; a null label is a cluster of
    its own, first in order; no labels give an empty array.
    """
    sizes = labels.groupBy("cluster_id").agg(F.count("*").alias("count"))
    return sizes.agg(
        F.sort_array(
            F.collect_list(
                F.struct("cluster_id", "count")
            )
        ).alias("cluster_sizes")
    ).select(
        F.lit(algorithm).alias("algorithm"),
        F.lit(int(k)).alias("k"),
        F.lit(int(max_iterations)).alias("max_iterations"),
        F.lit(float(tol)).alias("tol"),
        F.lit(int(seed)).alias("seed"),
        F.lit(init_mode).alias("init_mode"),
        F.lit(limit).cast("int").alias("limit"),
        F.lit(bool(test_mode)).alias("test_mode"),
        F.lit(float(training_cost)).alias("training_cost"),
        F.lit(silhouette_score).cast("double").alias("silhouette_score"),
        "cluster_sizes",
    )
