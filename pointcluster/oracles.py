"""SQL that DuckDB runs on the same tables, one text per registered query."""

from __future__ import annotations

from .plans.seeding import OVERSAMPLE, RECLUSTER, STEPS
from .queries import (
    EMB_EPS,
    EMB_MIN_PTS,
    FAR,
    K,
    K_LARGE,
    K_WIDE,
    LIMIT,
    LINK_EPS,
    MANY_CENTERS,
    MAX_ROUNDS,
    POINT_BOX,
    ROUNDS,
    SAMPLE,
    SEED,
    TOL,
    TOP,
    TRIP_EPS,
    TRIP_MIN_PTS,
    VARIANT_ROUNDS,
    VARIANT_TOL,
)

TRIPS = """trips AS MATERIALIZED (
  SELECT event_id AS id, ts AS pickup_datetime, value AS pickup_longitude,
    CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS pickup_latitude,
    CAST(user_id AS INTEGER) AS passenger_count
  FROM events)"""
BOXED = """pickup_longitude > 1 AND pickup_longitude < 300 AND pickup_latitude > 3600
  AND pickup_latitude < 82800 AND passenger_count > 0"""
RAW = "id, pickup_longitude, pickup_latitude, passenger_count"


def scaled(source: str, x: str, y: str, fit: str | None = None) -> str:
    """CTE p(id, f0, f1): min-max scaled by the bounds of ``fit``."""
    return f"""b AS (
  SELECT min({x}) AS x0, max({x}) AS x1, min({y}) AS y0, max({y}) AS y1
  FROM {fit or source}),
p AS MATERIALIZED (
  SELECT id, ({x} - x0) / (x1 - x0) AS f0, ({y} - y0) / (y1 - y0) AS f1
  FROM {source}, b)"""


X, Y = "pickup_longitude", "pickup_latitude"
POINTS = f"{TRIPS}, {scaled('trips', X, Y)}"
EMB3D = "e AS (SELECT vec_id AS id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(3)
) + " FROM embeddings), p AS MATERIALIZED (SELECT id, " + ", ".join(
    f"(e{i} - min(e{i}) OVER ()) / (max(e{i}) OVER () - min(e{i}) OVER ()) AS f{i}"
    for i in range(3)
) + " FROM e)"
EMB64 = "p AS MATERIALIZED (SELECT vec_id AS id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64)
) + " FROM embeddings)"


def dist_sq(a: str, b: str, d: int = 2) -> str:
    return " + ".join(f"({a}.f{i} - {b}.f{i}) * ({a}.f{i} - {b}.f{i})" for i in range(d))


def feats(d: int, prefix: str = "") -> str:
    return ", ".join(f"{prefix}f{i}" for i in range(d))


def start(k: int, d: int = 2) -> str:
    """CTE c0(k, f*): the first k points in seeded order."""
    order = f"md5('{SEED}:' || CAST(id AS VARCHAR)), id"
    return f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS k, {feats(d)}
  FROM (SELECT * FROM p ORDER BY {order} LIMIT {k}))"""


def assign(name: str, centers: str, d: int = 2) -> str:
    """CTE name(id, f*, k, d2): nearest center, the least k on ties."""
    return f"""{name} AS MATERIALIZED (
  SELECT id, any_value(k) FILTER (r = 1) AS k, any_value(d2) FILTER (r = 1) AS d2,
    {', '.join(f'any_value(f{i}) AS f{i}' for i in range(d))}
  FROM (SELECT p.id, {feats(d, 'p.')}, c.k, {dist_sq('p', 'c', d)} AS d2,
      row_number() OVER (PARTITION BY p.id ORDER BY {dist_sq('p', 'c', d)}, c.k) AS r
    FROM p, {centers} c) GROUP BY id)"""


def lloyd(rounds: int, d: int = 2) -> str:
    """CTEs a1, c1, ..., c<rounds> from c0; an empty cluster keeps its place."""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(assign(f"a{i}", f"c{i - 1}", d))
        means = ", ".join(f"coalesce(m.f{j}, c.f{j}) AS f{j}" for j in range(d))
        sums = ", ".join(f"avg(f{j}) AS f{j}" for j in range(d))
        steps.append(
            f"c{i} AS MATERIALIZED (SELECT c.k, {means} FROM c{i - 1} c "
            f"LEFT JOIN (SELECT k, {sums} FROM a{i} GROUP BY k) m USING (k))"
        )
    return ", ".join(steps)


def parallel_start(k: int, steps: int = STEPS, oversample: int = OVERSAMPLE) -> str:
    """CTE c0(k, f0, f1): k-means|| seeding with the draws of ``plans.seeding``."""
    order = f"md5('{SEED}:' || CAST(id AS VARCHAR)), id"
    parts = [f"s0 AS MATERIALIZED (SELECT 0 AS round, id, f0, f1 FROM p ORDER BY {order} LIMIT 1)"]
    for i in range(1, steps + 1):
        chance = f"md5('{SEED}:{i}:' || CAST(id AS VARCHAR))"
        parts += [
            f"n{i} AS MATERIALIZED (SELECT p.id, p.f0, p.f1, min({dist_sq('p', 's')}) AS d2 "
            f"FROM p, s{i - 1} s GROUP BY ALL)",
            f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL SELECT {i}, id, f0, f1 FROM n{i} "
            f"WHERE CAST(('0x' || substr({chance}, 1, 13)) AS BIGINT) / 4503599627370496.0 "
            f"* (SELECT sum(d2) FROM n{i}) < {oversample * k} * d2)",
        ]
    parts += [
        f"cand AS MATERIALIZED (SELECT row_number() OVER (ORDER BY round, id) AS j, f0, f1 FROM s{steps})",
        f"cw AS MATERIALIZED (SELECT j, any_value(f0) AS f0, any_value(f1) AS f1, count(id) AS w FROM ("
        f"SELECT cand.j, cand.f0, cand.f1, near.id FROM cand LEFT JOIN (SELECT p.id, c.j, row_number() "
        f"OVER (PARTITION BY p.id ORDER BY {dist_sq('p', 'c')}, c.j) AS r FROM p, cand c) near "
        "ON near.j = cand.j AND near.r = 1) GROUP BY j)",
        "t1 AS MATERIALIZED (SELECT 0 AS k, j, f0, f1 FROM cw ORDER BY w DESC, j LIMIT 1)",
    ]
    for i in range(2, k + 1):
        parts.append(
            f"t{i} AS MATERIALIZED (SELECT * FROM t{i - 1} UNION ALL (SELECT {i - 1}, j, f0, f1 FROM ("
            f"SELECT c.j, c.f0, c.f1, c.w * min({dist_sq('c', 't')}) AS score FROM cw c, t{i - 1} t "
            "GROUP BY c.j, c.f0, c.f1, c.w) ORDER BY score DESC, j LIMIT 1))"
        )
    last = f"t{k}"
    for i in range(1, RECLUSTER + 1):
        parts += [
            f"r{i} AS MATERIALIZED (SELECT c.*, t.k, row_number() OVER (PARTITION BY c.j "
            f"ORDER BY {dist_sq('c', 't')}, t.k) AS nth FROM cw c, {last} t)",
            f"u{i} AS MATERIALIZED (SELECT t.k, coalesce(m.f0, t.f0) AS f0, coalesce(m.f1, t.f1) AS f1 "
            f"FROM {last} t LEFT JOIN (SELECT k, sum(f0 * w) / sum(w) AS f0, sum(f1 * w) / sum(w) AS f1 "
            f"FROM r{i} WHERE nth = 1 AND w > 0 GROUP BY k) m USING (k))",
        ]
        last = f"u{i}"
    return ", ".join([*parts, f"c0 AS MATERIALIZED (SELECT CAST(k AS INTEGER) AS k, f0, f1 FROM {last})"])


def nearest(k: int, points: str = POINTS, d: int = 2) -> str:
    return f"WITH RECURSIVE {points}, {start(k, d)}, {assign('a', 'c0', d)}"


def centers(name: str) -> str:
    return (
        f"SELECT CAST(k AS INTEGER) AS cluster_id, round(f0, 6) AS c0, round(f1, 6) AS c1 "
        f"FROM {name}"
    )


def dims(name: str, d: int = 64) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST(k AS INTEGER) AS cluster_id, CAST({i} AS INTEGER) AS dim, "
        f"round(f{i}, 6) AS value FROM {name}"
        for i in range(d)
    )


def stopped(rounds: int, tol: float, norm: str) -> str:
    """CTEs sh(iter, shift), at(iter): the round at which the run stops."""
    moves = f"sqrt({dist_sq('n', 'o')})"
    total = f"sum({moves})" if norm == "sum" else f"sqrt(sum({dist_sq('n', 'o')}))"
    each = " UNION ALL ".join(
        f"SELECT {i} AS iter, (SELECT {total} FROM c{i} n JOIN c{i - 1} o USING (k)) AS shift"
        for i in range(1, rounds + 1)
    )
    return (
        f"sh AS ({each}), stop_at AS (SELECT coalesce(min(iter) FILTER (shift < {tol!r}), "
        f"{rounds}) AS iter FROM sh)"
    )


def rested(rounds: int) -> str:
    """The centers of the round at which the run stops."""
    return "rest AS (" + " UNION ALL ".join(
        f"SELECT {i} AS iter, k, f0, f1 FROM c{i}" for i in range(1, rounds + 1)
    ) + ")"


def dbscan(points: str, eps: float, min_pts: int, d: int = 2) -> str:
    """CTEs near, core, lab(id, cluster), edge(id, cluster) for border points."""
    d2 = dist_sq("a", "b", d)
    e = f"CAST({eps!r} AS DOUBLE)"
    return f"""WITH RECURSIVE {points},
near AS MATERIALIZED (
  SELECT a.id AS i, b.id AS j, {d2} AS d2 FROM p a, p b
  WHERE b.f0 >= a.f0 - {2 * eps!r} AND b.f0 <= a.f0 + {2 * eps!r} AND {d2} <= {e} * {e}),
core AS MATERIALIZED (SELECT i AS id FROM near GROUP BY i HAVING count(*) >= {min_pts}),
link AS MATERIALIZED (
  SELECT i, j, d2 FROM near
  WHERE i IN (SELECT id FROM core) AND j IN (SELECT id FROM core)),
reach AS (
  SELECT i, j FROM link UNION SELECT r.i, l.j FROM reach r JOIN link l ON r.j = l.i),
lab AS MATERIALIZED (SELECT i AS id, min(j) AS cluster FROM reach GROUP BY i),
touch AS MATERIALIZED (
  SELECT n.i AS id, lab.cluster, n.d2, n.j FROM near n JOIN lab ON lab.id = n.j
  WHERE n.i NOT IN (SELECT id FROM core)),
edge AS MATERIALIZED (
  SELECT id, cluster FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, j) AS r FROM touch)
  WHERE r = 1),
found AS MATERIALIZED (
  SELECT CAST(id AS VARCHAR) AS point_id, CAST(cluster AS VARCHAR) AS cluster_id
  FROM (SELECT * FROM lab UNION ALL SELECT * FROM edge)),
full_set AS MATERIALIZED (
  SELECT CAST(p.id AS VARCHAR) AS point_id, coalesce(f.cluster_id, '-1') AS cluster_id
  FROM p LEFT JOIN found f ON f.point_id = CAST(p.id AS VARCHAR))
"""


ON_TRIPS = dbscan(POINTS, TRIP_EPS, TRIP_MIN_PTS)
ON_EMB = dbscan(EMB3D, EMB_EPS, EMB_MIN_PTS, 3)
# cells of side eps / sqrt(2), a trace smaller; the points span one unit
SIDE = f"""(SELECT s * (1 - (CAST(1e-9 AS DOUBLE) + CAST(4e-15 AS DOUBLE) / s))
  FROM (SELECT CAST({TRIP_EPS!r} AS DOUBLE) / CAST(2 AS DOUBLE) ** CAST(0.5 AS DOUBLE) AS s))"""
CONVERGED = f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(MAX_ROUNDS)},
{stopped(MAX_ROUNDS, TOL, 'sum')}, {rested(MAX_ROUNDS)}
SELECT CAST(k AS INTEGER) AS cluster_id, round(f0, 6) AS c0, round(f1, 6) AS c1,
  CAST(iter AS INTEGER) AS rounds FROM rest JOIN stop_at USING (iter)"""
TOP_CLUSTERS = f"""top AS (
  SELECT cluster_id, count(*) AS "count" FROM found GROUP BY cluster_id
  ORDER BY count(*) DESC, cluster_id LIMIT {TOP})"""

# mean squared distance of a point to each cluster, its own without itself
SILHOUETTE_SQ = """
s AS (SELECT k, count(*) AS n, {sums}, sum({norm}) AS q FROM a GROUP BY k),
v AS (
  SELECT a.id, a.k = s.k AS own, s.n,
    ({norm_a}) - 2 * ({dot}) / s.n + s.q / s.n AS m
  FROM a, s),
w AS (
  SELECT id, max(CASE WHEN own AND n > 1 THEN m * n / (n - 1) END) AS x,
    min(CASE WHEN NOT own THEN m END) AS y
  FROM v GROUP BY id)
SELECT round(avg(CASE WHEN x IS NULL THEN 0 ELSE (y - x) / greatest(x, y) END), 6)
  AS silhouette FROM w"""


def silhouette_sq(d: int) -> str:
    return SILHOUETTE_SQ.format(
        sums=", ".join(f"sum(f{i}) AS s{i}" for i in range(d)),
        norm=" + ".join(f"f{i} * f{i}" for i in range(d)),
        norm_a=" + ".join(f"a.f{i} * a.f{i}" for i in range(d)),
        dot=" + ".join(f"a.f{i} * s.s{i}" for i in range(d)),
    )


def elkan_state(round_one: bool) -> str:
    """Bounds after the initial distances, or after one further round."""
    base = f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(1)},
l AS MATERIALIZED (
  SELECT p.id, p.f0, p.f1, c.k, sqrt({dist_sq('p', 'c')}) AS low FROM p, c0 c),
s0 AS MATERIALIZED (
  SELECT l.id, a1.k AS c, min(l.low) AS u FROM l JOIN a1 USING (id) GROUP BY l.id, a1.k)"""
    lows = ", ".join(
        f"round(max(low) FILTER (k = {j}), 6) AS l{j}" for j in range(K)
    )
    if not round_one:
        return f"""{base}
SELECT s0.id, CAST(s0.c AS INTEGER) AS c, round(s0.u, 6) AS u, {lows},
  CAST({K} AS BIGINT) AS n_dist
FROM s0 JOIN l USING (id) GROUP BY s0.id, s0.c, s0.u"""
    return f"""{base},
mv AS (SELECT n.k, sqrt({dist_sq('n', 'o')}) AS m FROM c1 n JOIN c0 o USING (k)),
cc AS (SELECT a.k AS i, b.k AS j, sqrt({dist_sq('a', 'b')}) / 2 AS h FROM c1 a, c1 b),
gap AS (SELECT i, min(h) AS s FROM cc WHERE i <> j GROUP BY i),
t AS MATERIALIZED (
  SELECT l.id, l.f0, l.f1, l.k, s0.c, s0.u + mc.m AS u, greatest(0, l.low - ml.m) AS low,
    cc.h, gap.s
  FROM l JOIN s0 USING (id) JOIN mv mc ON mc.k = s0.c JOIN mv ml ON ml.k = l.k
    JOIN cc ON cc.i = s0.c AND cc.j = l.k JOIN gap ON gap.i = s0.c),
o AS (
  SELECT id, bool_or(k <> c AND u > s AND u > low AND u > h) AS opened FROM t GROUP BY id),
g AS MATERIALIZED (
  SELECT t.*, o.opened, sqrt({dist_sq('t', 'n')}) AS exact,
    CASE WHEN o.opened THEN sqrt({dist_sq('t', 'w')}) ELSE t.u END AS v
  FROM t JOIN o USING (id) JOIN c1 n ON n.k = t.k JOIN c1 w ON w.k = t.c),
r AS MATERIALIZED (
  SELECT *, opened AND k <> c AND v > low AND v > h AS tried FROM g),
z AS (
  SELECT id, c, v, opened, k, tried, exact,
    CASE WHEN tried THEN exact WHEN opened AND k = c THEN v ELSE low END AS low
  FROM r)
SELECT id,
  CAST(coalesce(arg_min(k, exact) FILTER (tried AND exact < v), any_value(c)) AS INTEGER) AS c,
  round(least(any_value(v), min(exact) FILTER (tried)), 6) AS u, {lows},
  CAST(count(*) FILTER (tried) + CASE WHEN any_value(opened) THEN 1 ELSE 0 END AS BIGINT)
    AS n_dist
FROM z GROUP BY id"""


def shifts(rounds: int) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS iter, round((SELECT sum(sqrt({dist_sq('n', 'o')})) "
        f"FROM c{i} n JOIN c{i - 1} o USING (k)), 6) AS shift, "
        f"CAST((SELECT count(*) FROM p) * {K} AS BIGINT) AS n_dist"
        for i in range(1, rounds + 1)
    )


def variant() -> str:
    """Far-off last center: empty in round one, then the first point in the order of
    the seed plus one; Frobenius norm below the tolerance ends the run."""
    fresh = f"md5('{SEED + 1}:' || CAST(id AS VARCHAR)), id"
    rest = lloyd(VARIANT_ROUNDS).replace(
        "SELECT c.k, coalesce(m.f0, c.f0) AS f0, coalesce(m.f1, c.f1) AS f1 FROM c0 c",
        "SELECT c.k, coalesce(m.f0, (SELECT f0 FROM fresh)) AS f0, "
        "coalesce(m.f1, (SELECT f1 FROM fresh)) AS f1 FROM c0 c",
    )
    first = start(K - 1).replace("c0 AS MATERIALIZED (", "c0 AS MATERIALIZED (SELECT * FROM (", 1)
    last = f" UNION ALL SELECT {K - 1}, CAST({FAR!r} AS DOUBLE), CAST({FAR!r} AS DOUBLE))"
    first = first.removesuffix(")")
    labels = " UNION ALL ".join(
        f"SELECT {i} AS iter, id, k, f0, f1 FROM a{i}" for i in range(1, VARIANT_ROUNDS + 1)
    )
    return f"""WITH RECURSIVE {POINTS}, {first}){last},
fresh AS (SELECT f0, f1 FROM p ORDER BY {fresh} LIMIT 1), {rest},
{stopped(VARIANT_ROUNDS, VARIANT_TOL, 'l2')}, {rested(VARIANT_ROUNDS)},
c AS (SELECT * FROM rest JOIN stop_at USING (iter)),
a AS (SELECT * FROM ({labels}) JOIN stop_at USING (iter)),
z AS (SELECT k, count(*) AS n FROM a GROUP BY k),
t AS (SELECT round(sum({dist_sq('a', 'c')}), 6) AS inertia FROM a JOIN c USING (k))
SELECT CAST(k AS INTEGER) AS cluster_id, round(f0, 6) AS c0, round(f1, 6) AS c1,
  coalesce(n, 0) AS n, inertia, CAST(iter AS INTEGER) AS rounds
FROM c LEFT JOIN z USING (k), t"""


VARIANT = variant()
LABELLED = f"{nearest(K)}"
LABELLED_LARGE = f"{nearest(K_LARGE)}"

ORACLES: dict[str, str] = {
    "src_csv_roundtrip": f"""WITH {TRIPS}
SELECT id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup_datetime,
  pickup_longitude, pickup_latitude, passenger_count FROM trips""",
    "src_pruned": f"WITH {TRIPS} SELECT {RAW} FROM trips",
    "src_points_roundtrip": f"""WITH {POINTS}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p""",
    "src_scaler_roundtrip": f"""WITH {TRIPS}
SELECT CAST(0 AS INTEGER) AS feature, min({X}) AS min_val, max({X}) AS max_val FROM trips
UNION ALL SELECT 1, min({Y}), max({Y}) FROM trips""",
    "src_centroids_roundtrip": f"WITH {POINTS}, {start(K)} {centers('c0')}",
    "src_assignments_roundtrip": f"""{LABELLED}
SELECT CAST(id AS VARCHAR) AS point_id, k AS cluster_id FROM a""",
    "src_replaced": f"""WITH {POINTS}
SELECT id, round(1 - f0 / 2, 6) AS f0, round(1 - f1 / 2, 6) AS f1 FROM p""",
    "src_placed_box": f"WITH {TRIPS} SELECT {RAW} FROM trips WHERE {BOXED}",
    "src_placed_points": f"""WITH {POINTS}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p WHERE """
    + " AND ".join(f"f{i} > {lo} AND f{i} < {hi}" for i, (lo, hi) in enumerate(POINT_BOX)),
    "filter_box": f"WITH {TRIPS} SELECT {RAW} FROM trips WHERE {BOXED}",
    "feature_hour": "SELECT event_id AS id, CAST(hour(ts) AS INTEGER) AS pickup_hour FROM events",
    "feature_assemble": f"""WITH {TRIPS}
SELECT id, CAST(3 AS INTEGER) AS width, {X} AS f0, {Y} AS f1,
  CAST(passenger_count AS DOUBLE) AS f2 FROM trips""",
    "topn_cluster_points": f"""{ON_TRIPS}, {TOP_CLUSTERS}
SELECT point_id, cluster_id FROM found WHERE cluster_id IN (SELECT cluster_id FROM top)""",
    "minmax_bounds": f"""WITH {TRIPS}
SELECT CAST(0 AS INTEGER) AS feature, min({X}) AS min_val, max({X}) AS max_val FROM trips
UNION ALL SELECT 1, min({Y}), max({Y}) FROM trips""",
    "minmax_scale": f"""WITH {POINTS}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p""",
    "scale_with_saved": f"""WITH {TRIPS}, boxed AS (SELECT * FROM trips WHERE {BOXED}),
{scaled('trips', X, Y, 'boxed')}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p""",
    "inverse_scale": f"""WITH {TRIPS}
SELECT id, round({X}, 6) AS f0, round({Y}, 6) AS f1 FROM trips""",
    "limit_then_filter": f"""WITH {TRIPS},
head AS (SELECT * FROM trips ORDER BY id LIMIT 1000)
SELECT {RAW} FROM head WHERE {BOXED}""",
    "limit_points": f"""WITH {TRIPS}
SELECT id, round({X}, 6) AS f0, round({Y}, 6) AS f1
FROM trips WHERE {BOXED} ORDER BY id LIMIT {LIMIT}""",
    "limit_points_string_ids": f"""WITH {TRIPS}
SELECT 'trip' || CAST(id AS VARCHAR) AS id, round({X}, 6) AS f0, round({Y}, 6) AS f1
FROM trips ORDER BY 1 LIMIT {LIMIT}""",
    "seeded_sample": f"""WITH {POINTS}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p
ORDER BY md5('{SEED}:' || CAST(id AS VARCHAR)), id LIMIT {K_LARGE}""",
    "seeded_sample_capped": f"""WITH {POINTS}
SELECT id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM p
ORDER BY md5('{SEED}:' || CAST(id AS VARCHAR)), id LIMIT {SAMPLE}""",
    "label_join": f"""{LABELLED}
SELECT id, k AS cluster_id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM a WHERE k <> 0""",
    "assign_nearest": f"""{LABELLED_LARGE}
SELECT id, k AS cluster_id, round(d2, 6) AS dist_sq FROM a""",
    "assign_nearest_k40": f"""{nearest(K_WIDE)}
SELECT id, k AS cluster_id, round(d2, 6) AS dist_sq FROM a""",
    "assign_nearest_wide": f"""{nearest(K, EMB64, 64)}
SELECT id, k AS cluster_id, round(d2, 6) AS dist_sq FROM a""",
    "assign_nearest_many": f"""WITH {POINTS},
c AS (SELECT * FROM p ORDER BY md5('{SEED}:' || CAST(id AS VARCHAR)), id LIMIT {MANY_CENTERS}),
n AS (SELECT p.id, min(struct_pack(d2 := {dist_sq('p', 'c', 2)}, k := c.id)) AS best FROM p, c GROUP BY p.id)
SELECT id, CAST(best.k AS INTEGER) AS cluster_id, round(best.d2, 9) AS dist_sq FROM n""",
    "eps_neighbors": f"""{ON_TRIPS}
SELECT i AS id, j AS neighbor_id, round(d2, 9) AS dist_sq FROM near""",
    "centroid_distances": f"""WITH {POINTS}, {start(K_LARGE)},
cc AS (SELECT a.k AS i, b.k AS j, sqrt({dist_sq('a', 'b')}) AS dist FROM c0 a, c0 b),
g AS (SELECT i, min(dist) / 2 AS half_gap FROM cc WHERE i <> j GROUP BY i)
SELECT cc.i, cc.j, round(dist, 6) AS dist, round(half_gap, 6) AS half_gap
FROM cc JOIN g USING (i)""",
    "label_remap": f"""{ON_TRIPS},
cell AS (
  SELECT lab.id, lab.cluster, floor((f0 - (SELECT min(f0) FROM p)) / {SIDE}) AS cx,
    floor((f1 - (SELECT min(f1) FROM p)) / {SIDE}) AS cy
  FROM lab JOIN p USING (id))
SELECT id, min(id) OVER (PARTITION BY cx, cy) AS local_id, cluster AS cluster_id FROM cell""",
    "centroid_compare": f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(2)}
SELECT 'cluster_' || CAST(k AS VARCHAR) AS cluster,
  round(s.f0, 6) AS start_scaled_0, round(s.f1, 6) AS start_scaled_1,
  round(l.f0, 6) AS lloyd_scaled_0, round(l.f1, 6) AS lloyd_scaled_1,
  round(s.f0 * (x1 - x0) + x0, 6) AS start_0, round(s.f1 * (y1 - y0) + y0, 6) AS start_1,
  round(l.f0 * (x1 - x0) + x0, 6) AS lloyd_0, round(l.f1 * (y1 - y0) + y0, 6) AS lloyd_1
FROM c0 s JOIN c2 l USING (k), b""",
    "centroid_update": f"""{LABELLED}
SELECT k AS cluster_id, count(*) AS n, round(avg(f0), 6) AS c0, round(avg(f1), 6) AS c1
FROM a GROUP BY k""",
    "cluster_sizes": f"""{LABELLED_LARGE}
SELECT k AS cluster_id, count(*) AS "count" FROM a GROUP BY k""",
    "row_counts": f"""WITH {TRIPS}
SELECT count(*) AS n_raw, count(*) FILTER ({BOXED}) AS n_kept FROM trips""",
    "distinct_clusters": f"""{LABELLED_LARGE}
SELECT count(DISTINCT k) AS n_clusters FROM a""",
    "label_overlap": f"""{ON_TRIPS},
member AS (SELECT id, cluster FROM lab UNION SELECT id, cluster FROM touch)
SELECT id AS point_id, string_agg(CAST(cluster AS VARCHAR), ',' ORDER BY cluster) AS labels
FROM member GROUP BY id HAVING count(*) > 1""",
    "inertia": f"{LABELLED} SELECT round(sum(d2), 6) AS inertia FROM a",
    "inertia_wide": f"{nearest(K, EMB64, 64)} SELECT round(sum(d2), 6) AS inertia FROM a",
    "silhouette_sq": f"{LABELLED}, {silhouette_sq(2)}",
    "silhouette_sq_wide": f"{nearest(K, EMB64, 64)}, {silhouette_sq(64)}",
    "silhouette_euclid": f"""{LABELLED},
u AS MATERIALIZED (
  SELECT * FROM a ORDER BY md5('{SEED}:' || CAST(id AS VARCHAR)), id LIMIT 100000),
m AS (SELECT k, count(*) AS n FROM u GROUP BY k),
v AS (SELECT x.id, x.k AS own, y.k, sum(sqrt({dist_sq('x', 'y')})) AS t
  FROM u x, u y GROUP BY x.id, x.k, y.k),
w AS (SELECT v.id, max(CASE WHEN v.k = own AND n > 1 THEN t / (n - 1) END) AS x,
    min(CASE WHEN v.k <> own THEN t / n END) AS y
  FROM v JOIN m ON m.k = v.k GROUP BY v.id)
SELECT 'nearest' AS algorithm, CAST((SELECT count(DISTINCT k) FROM a) AS INTEGER) AS k,
  (SELECT count(*) FROM a) AS n_points, (SELECT count(*) FROM u) AS silhouette_sample_size,
  round(avg(CASE WHEN x IS NULL THEN 0 ELSE (y - x) / greatest(x, y) END), 6)
    AS silhouette_score FROM w""",
    "silhouette_all": f"""{LABELLED},
m AS (SELECT k, count(*) AS n FROM a GROUP BY k),
v AS (SELECT x.id, x.k AS own, y.k, sum(sqrt({dist_sq('x', 'y')})) AS t
  FROM a x, a y GROUP BY x.id, x.k, y.k),
w AS (SELECT v.id, max(CASE WHEN v.k = own AND n > 1 THEN t / (n - 1) END) AS x,
    min(CASE WHEN v.k <> own THEN t / n END) AS y
  FROM v JOIN m ON m.k = v.k GROUP BY v.id)
SELECT 'nearest' AS algorithm, CAST(count(DISTINCT a.k) AS INTEGER) AS k, count(*) AS n_points,
  round(avg(CASE WHEN x IS NULL THEN 0 ELSE (y - x) / greatest(x, y) END), 3)
    AS silhouette_score FROM w JOIN a ON a.id = w.id""",
    "kmeans_history": f"WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(ROUNDS)} {shifts(ROUNDS)}",
    "run_metrics": f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(2)}, {assign('a', 'c2')},
sil AS ({silhouette_sq(2).replace('s AS (', 'WITH s AS (', 1)}),
z AS (SELECT k, count(*) AS n FROM a GROUP BY k)
SELECT 'lloyd' AS algorithm, CAST({K} AS INTEGER) AS k, CAST(2 AS INTEGER) AS max_iterations,
  CAST(0 AS DOUBLE) AS tol, CAST({SEED} AS INTEGER) AS seed, 'seeded' AS init_mode,
  CAST(NULL AS INTEGER) AS "limit", false AS test_mode,
  (SELECT round(sum(d2), 6) FROM a) AS training_cost,
  (SELECT silhouette FROM sil) AS silhouette_score,
  (SELECT '[' || string_agg('{{"cluster_id":' || k || ',"count":' || n || '}}', ',' ORDER BY k)
    || ']' FROM z) AS cluster_sizes""",
    "kmeans_centroids": f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(ROUNDS)}
{centers(f'c{ROUNDS}')}""",
    "kmeans_centroids_k11": f"""WITH RECURSIVE {POINTS}, {start(K_LARGE)}, {lloyd(ROUNDS)}
{centers(f'c{ROUNDS}')}""",
    "kmeans_resumed": f"WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(ROUNDS)} {shifts(ROUNDS)}",
    "tree_kmeans_centroids": f"""WITH RECURSIVE {POINTS}, {start(K_LARGE)}, {lloyd(ROUNDS)}
{centers(f'c{ROUNDS}')}""",
    "tree_kmeans_converged": CONVERGED,
    "kmeans_wide": f"""WITH RECURSIVE {EMB64}, {start(K, 64)}, {lloyd(ROUNDS, 64)}
{dims(f'c{ROUNDS}')}""",
    "kmeans_parallel_start": f"WITH {POINTS}, {parallel_start(K)} {centers('c0')}",
    "kmeans_parallel": f"""WITH RECURSIVE {POINTS}, {parallel_start(K)}, {lloyd(2)}
{centers('c2')}""",
    "elkan_parallel": f"""WITH RECURSIVE {POINTS}, {parallel_start(K)}, {lloyd(2)}
{centers('c2')}""",
    "kmeans_variant": VARIANT,
    "ml_kmeans_groups": f"""WITH g AS (
  SELECT event_type, CAST(100 * ascii(event_type) + 10000 * length(event_type) AS DOUBLE) AS z,
    value FROM events),
p AS (SELECT event_type, z + value / 1000 AS f0, -2 * z - value / 500 AS f1 FROM g),
m AS (SELECT event_type, count(*) AS n, avg(f0) AS c0, avg(f1) AS c1 FROM p GROUP BY event_type),
t AS (SELECT sum((f0 - c0) ** 2 + (f1 - c1) ** 2) AS cost FROM p JOIN m USING (event_type))
SELECT 'k-means||' AS init_mode, round(c0, 4) AS c0, round(c1, 4) AS c1, n,
  round(cost, 2) AS training_cost FROM m, t""",
    "ml_kmeans_random": f"""WITH p AS (
  SELECT length(event_type) >= 6 AS g, CASE WHEN g THEN 50000 ELSE 0 END + value / 1000 AS f0,
    value / 500 AS f1 FROM events),
m AS (SELECT g, count(*) AS n, avg(f0) AS c0, avg(f1) AS c1 FROM p GROUP BY g),
t AS (SELECT sum((f0 - c0) ** 2 + (f1 - c1) ** 2) AS cost FROM p JOIN m USING (g))
SELECT 'random' AS init_mode, round(c0, 4) AS c0, round(c1, 4) AS c1, n,
  round(cost, 2) AS training_cost FROM m, t""",
    "elkan_centroids": f"""WITH RECURSIVE {POINTS}, {start(K)}, {lloyd(ROUNDS)}
{centers(f'c{ROUNDS}')}""",
    "elkan_wide": f"""WITH RECURSIVE {EMB64}, {start(K, 64)}, {lloyd(ROUNDS, 64)}
{dims(f'c{ROUNDS}')}""",
    "kmeans_converged": CONVERGED,
    "elkan_converged": CONVERGED,
    "elkan_init": elkan_state(False),
    "elkan_step": elkan_state(True),
    "predict_nearest": f"""WITH {TRIPS}, boxed AS (SELECT * FROM trips WHERE {BOXED}),
{scaled('boxed', X, Y)}, {start(K)}, {assign('a', 'c0')}
SELECT CAST(id AS VARCHAR) AS point_id, k AS cluster_id, round(f0, 6) AS scaled_longitude,
  round(f1, 6) AS scaled_latitude FROM a""",
    "dbscan_labels": f"{ON_TRIPS} SELECT * FROM found",
    "dbscan_labels_emb": f"{ON_EMB} SELECT * FROM found",
    "dbscan_core": f"""{ON_TRIPS}
SELECT p.id, core.id IS NOT NULL AS is_core FROM p LEFT JOIN core USING (id)""",
    "dbscan_border": f"{ON_TRIPS} SELECT id, cluster AS cluster_id FROM edge",
    "dbscan_with_noise": f"{ON_TRIPS} SELECT * FROM full_set",
    "dbscan_no_noise": f"{ON_TRIPS} SELECT * FROM full_set WHERE cluster_id <> '-1'",
    "dbscan_summary": f"""{ON_TRIPS}
SELECT count(*) AS n_points, count(*) FILTER (cluster_id = '-1') AS n_noise,
  count(DISTINCT CASE WHEN cluster_id <> '-1' THEN cluster_id END) AS n_clusters
FROM full_set""",
    "dbscan_top_clusters": f"{ON_TRIPS}, {TOP_CLUSTERS} SELECT * FROM top",
    "connected_components": f"""WITH RECURSIVE {POINTS},
near AS MATERIALIZED (
  SELECT a.id AS i, b.id AS j FROM p a, p b
  WHERE b.f0 >= a.f0 - {2 * LINK_EPS!r} AND b.f0 <= a.f0 + {2 * LINK_EPS!r}
    AND {dist_sq('a', 'b')} <= CAST({LINK_EPS!r} AS DOUBLE) * CAST({LINK_EPS!r} AS DOUBLE)),
reach AS (
  SELECT i, j FROM near UNION SELECT r.i, n.j FROM reach r JOIN near n ON r.j = n.i)
SELECT i AS id, min(j) AS comp FROM reach GROUP BY i""",
    "grid_cells": f"""WITH {POINTS}
SELECT id, CAST(floor((f0 - (SELECT min(f0) FROM p)) / CAST(0.02 AS DOUBLE)) AS BIGINT) AS c0,
  CAST(floor((f1 - (SELECT min(f1) FROM p)) / CAST(0.02 AS DOUBLE)) AS BIGINT) AS c1 FROM p""",
    "preprocess_cluster_sizes": f"""WITH RECURSIVE {TRIPS},
boxed AS (SELECT * FROM trips WHERE {BOXED}), {scaled('boxed', X, Y)},
{start(K)}, {lloyd(ROUNDS)}, {assign('a', f'c{ROUNDS}')}
SELECT k AS cluster_id, count(*) AS "count" FROM a GROUP BY k""",
}
