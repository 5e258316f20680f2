"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

Vectors become integers, ``floor(256 x)``, padded with zeros to a power of two, D, and
are rotated by random signs and a Hadamard transform: integers again, and inner products
grow by exactly D. A rotated vector y keeps one sign bit per component and two numbers,
its alignment c = sum|y| / D with its own code s, and the length r of what the code
leaves over: y = c s + rest, the rest orthogonal to s. For an anchor q

    <y, q> = c <s, q> + <rest, q>,   |<rest, q>| <= r sqrt(|q|^2 - <s, q>^2 / D)

by Cauchy and Schwarz. <s, q> comes from popcounts of the code with the bit planes of
q, cut to ``PLANES`` bits; the cut's L1 error widens the interval. So every row has an
interval that surely holds its score. The best estimates are scored first; rows whose
interval can still reach the threshold these set are scored as integers, all others
cannot be in the result. The result is exact whatever the codes are worth.

Anchors meet the rows in blocks: a task holds one block of vectors and one of anchors
and returns the best few per anchor, which window limits merge.

Rows with a null label or vector, or a null or non-finite component, take no part; a null
id takes no part either, as it could not be ordered. Shorter vectors count as padded with
zeros. Rows that share an anchor's vec_id are not its partners. Repeated rows are rows of
their own; equal anchor rows count once. Ties go by the smaller vec_id. Empty tables
give no rows. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Tables, released, sliced, table
from .wordhash import stream

PLANES = 7
BLOCK = 4096
ANCHORS = 1024
BROADCAST_BYTES = 32 << 20
SEEDS = 64
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score

BLOCK_SCHEMA = "block long, ids binary, labels binary, x binary, codes binary, c binary, r binary"
ANCHOR_SCHEMA = "anchors long, keys binary, ids binary, labels binary, x binary, good array<binary>"


def integers(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, label, x array<bigint>)`` of the rows that take part."""
    v = F.col(vector)
    whole = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & whole
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(v, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("x"),
    )


def width(d: int) -> int:
    """The power of two, at least 64, that holds ``d`` components."""
    return max(64, 1 << max(0, d - 1).bit_length())


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows of ``x (n, D)`` under fixed random signs and the Hadamard transform."""
    n, size = x.shape
    signs = np.where(stream(size, 77) >> np.uint64(63) == 1, 1, -1)
    y = x * signs
    step = 1
    while step < size:
        y = y.reshape(n, -1, 2, step)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return y


def bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans ``(n, D)`` as words of 64 bits ``(n, D / 64)``."""
    return np.ascontiguousarray(np.packbits(rows, axis=1)).view(np.uint64)


def code(x: np.ndarray):
    """``(codes, c, r)`` of integer rows."""
    y = rotate(x.astype(np.float64))
    c = np.abs(y).mean(axis=1)
    rest = np.maximum((y * y).sum(axis=1) - c * c * x.shape[1], 0)
    return bits(y >= 0), c, np.sqrt(rest) * (1 + 1e-9)


class Query:
    """One anchor and the bit planes of its rotated form ``y``."""

    def __init__(self, x: np.ndarray, y: np.ndarray | None = None):
        y = rotate(x[None, :].astype(np.float64))[0] if y is None else y
        self.x, self.size = x, len(y)
        self.low = y.min()
        self.step = (y.max() - self.low) / (2**PLANES - 1) or 1.0
        u = np.rint((y - self.low) / self.step)
        self.total = u.sum()
        self.error = np.abs(y - (self.low + self.step * u)).sum() * (1 + 1e-9) + 1e-9
        self.length = (y * y).sum()
        self.planes = bits((u.astype(np.int64)[None, :] >> np.arange(PLANES)[:, None] & 1) == 1)

    def interval(self, rows: Rows):
        """``(estimate, lower, upper)`` of the integer scores of coded rows."""
        inside = np.zeros(len(rows.ids))
        for j, plane in enumerate(self.planes):
            for word, own in zip(plane, rows.codes):
                inside += np.bitwise_count(own & word) * float(1 << j)
        s_q = self.low * (2 * rows.ones - self.size) + self.step * (2 * inside - self.total)
        sure = np.maximum(np.abs(s_q) - self.error, 0)
        half = rows.r * np.sqrt(np.maximum(self.length - sure * sure / self.size, 0))
        half += rows.c * self.error
        guess = rows.c * s_q
        half += 1e-9 * (half + np.abs(guess)) + 1e-6
        return guess / self.size, (guess - half) / self.size, (guess + half) / self.size


class Rows:
    """Coded rows of a block; codes are kept word by word."""

    def __init__(self, ids, x, codes, c, r, most=None):
        self.ids, self.x, self.codes, self.c, self.r = ids, x, codes, c, r
        self.ones = sum((np.bitwise_count(w).astype(float) for w in codes), np.zeros(len(ids)))
        self.most = float(np.abs(x).max(initial=0)) if most is None else most

    def of(self, rows: np.ndarray) -> Rows:
        codes = [w[rows] for w in self.codes]
        return Rows(self.ids[rows], self.x[rows], codes, self.c[rows], self.r[rows], self.most)

    def exact(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer inner products."""
        most = self.most * float(np.abs(q).max(initial=0)) * len(q)
        if most < 2**53:
            if not hasattr(self, "floats"):
                self.floats = self.x.astype(np.float64)
            q = q.astype(np.float64)
            few = 4 * len(rows) < len(self.ids)
            found = self.floats[rows] @ q if few else (self.floats @ q)[rows]
            return found.astype(np.int64)
        if most < 2**62:
            return self.x[rows] @ q
        found = [int(sum(int(a) * int(b) for a, b in zip(v, q))) for v in self.x[rows]]
        if any(abs(s) >= 2**63 for s in found):
            raise ValueError("a score does not fit 64 bits")
        return np.array(found, np.int64)


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, in order."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def nearest(rows: Rows, query: Query, own: int, k: int):
    """``(ids, scores)`` of the ``k`` best rows but those with the id ``own``."""
    left = np.flatnonzero(rows.ids != own)
    if len(left) > k:
        guess, _, upper = query.interval(rows)
        seeds = left[np.argpartition(guess[left], -k)[-k:]]
        left = left[upper[left] >= rows.exact(query.x, seeds).min()]
    scores = rows.exact(query.x, left)
    at = first(rows.ids[left], scores, k)
    return rows.ids[left[at]], scores[at]


def in_bands(rows: Rows, query: Query, others: np.ndarray, goods: np.ndarray, k: int):
    """For each positive score in ``goods``: ``(ids, scores)`` of the ``k`` best of the rows
    in the mask ``others`` whose score lies between LOW and HIGH per cent of it."""
    guess, lower, upper = query.interval(rows)
    wanted = np.zeros(len(others), bool)
    for good in goods.tolist():
        possible = others & (upper >= LOW * good / 100) & (lower <= HIGH * good / 100)
        places = np.flatnonzero(possible)
        if len(places) > SEEDS:
            # those whose estimates lie closest to the band's upper end
            away = np.abs(guess[places] - HIGH * good / 100)
            seeds = places[np.argpartition(away, SEEDS)[:SEEDS]]
            scores = rows.exact(query.x, seeds)
            scores = scores[(100 * scores >= LOW * good) & (100 * scores <= HIGH * good)]
            if len(scores) >= k:
                possible &= upper >= np.partition(scores, -k)[-k]
        wanted |= possible
    left = np.flatnonzero(wanted)
    scores = rows.exact(query.x, left)
    out = []
    for good in goods.tolist():
        near = np.flatnonzero((100 * scores >= LOW * good) & (100 * scores <= HIGH * good))
        at = near[first(rows.ids[left[near]], scores[near], k)]
        out.append((rows.ids[left[at]], scores[at]))
    return out


def _matrix(column, size: int) -> np.ndarray:
    """A list column of integers as rows padded with zeros."""
    lens = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    out = np.zeros((len(lens), size), np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(np.arange(len(lens)), lens), at] = values
    return out


def _gathered(batches, rows: int):
    """Arrow batches joined and cut to ``rows`` rows each (the last may be shorter)."""
    held, n = [], 0
    for batch in batches:
        for part in sliced([batch], rows):
            while part.num_rows:
                took = part.slice(0, rows - n)
                held, n, part = [*held, took], n + took.num_rows, part.slice(took.num_rows)
                if n == rows:
                    yield pa.concat_batches(held)
                    held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def vector_blocks(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """Blocks of at most ``BLOCK`` coded rows."""

    def run(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in _gathered(batches, BLOCK):
            x = _matrix(batch.column("x"), size)
            codes, c, r = code(x)
            parts = [
                batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), x, codes, c, r
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | n]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                names=["block", "ids", "labels", "x", "codes", "c", "r"],
            )
            n += 1

    return rows.repartition(parts).mapInArrow(released(run), BLOCK_SCHEMA)


def anchor_blocks(anchors: DataFrame, size: int, parts: int) -> DataFrame:
    """Blocks of at most ``ANCHORS`` anchors ``(key, vec_id, label, x, goods)``."""

    def run(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in _gathered(batches, ANCHORS):
            x = _matrix(batch.column("x"), size)
            goods = [np.array(g or [], np.int64).tobytes() for g in batch.column("goods").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | n]),
                    *[pa.array([batch.column(c).to_numpy().tobytes()], pa.binary())
                      for c in ("key", "vec_id", "label")],
                    pa.array([x.tobytes()], pa.binary()),
                    pa.array([goods], pa.list_(pa.binary())),
                ],
                names=["anchors", "keys", "ids", "labels", "x", "good"],
            )
            n += 1

    return anchors.repartition(parts, "key").mapInArrow(released(run), ANCHOR_SCHEMA)


def _alike(rows: Rows, labels: np.ndarray, label: int, known: dict) -> tuple[Rows, np.ndarray]:
    if label not in known:
        known[label] = rows.of(np.flatnonzero(labels == label)), labels != label
    return known[label]


def _meet(blocks: DataFrame, anchors: DataFrame, tables: Tables, size: int, work, schema: str):
    """``work(rows, alike, key, anchor, query, goods)`` for every block and anchor; ``alike``: the
    rows with the anchor's label, and a mask of the others.

    Anchor blocks are broadcast up to ``BROADCAST_BYTES``; larger sets meet the vector
    blocks in a join whose key names both blocks.
    """
    anchors = tables.store(anchors, "anchors")
    listed = [r[0] for r in anchors.select("anchors").collect()]  # a number per ANCHORS anchors
    n_blocks = blocks.count()
    if not listed or not n_blocks:
        return blocks.sparkSession.createDataFrame([], schema)
    small = len(listed) * ANCHORS * (size * 8 + 64) <= BROADCAST_BYTES
    asked = blocks.withColumn("anchors", F.explode(F.lit(listed)))
    theirs = anchors.withColumnsRenamed({"ids": "a_ids", "labels": "a_labels", "x": "a_x"})
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, n_blocks * len(listed) // 8)
    if small:
        met = asked.repartition(parts, "block", "anchors").join(F.broadcast(theirs), "anchors")
    else:
        known = blocks.select("block")
        theirs = theirs.join(known.withColumn("_on", F.explode(F.lit(listed))), F.col("_on") == F.col("anchors"))
        met = asked.join(theirs.drop("_on"), ["block", "anchors"]).repartition(parts, "block", "anchors")

    def run(batches):
        for batch in sliced(batches, 1):
            row = {n: batch.column(n)[0].as_py() for n in batch.schema.names}
            numbers = {"ids": np.int64, "labels": np.int64, "c": float, "r": float}
            block = {n: np.frombuffer(row[n], kind) for n, kind in numbers.items()}
            words = np.frombuffer(row["codes"], np.uint64).reshape(-1, size // 64)
            rows = Rows(
                block["ids"], np.frombuffer(row["x"], np.int64).reshape(-1, size),
                list(np.ascontiguousarray(words.T)), block["c"], block["r"],
            )
            of_label = {}
            keys, ids, labels = (
                np.frombuffer(row[n], np.int64) for n in ("keys", "a_ids", "a_labels")
            )
            x = np.frombuffer(row["a_x"], np.int64).reshape(-1, size)
            rotated = rotate(x.astype(np.float64))
            found = [
                out
                for key, a, q, y, label, good in zip(keys, ids, x, rotated, labels, row["good"])
                for out in work(
                    rows, _alike(rows, block["labels"], label, of_label), int(key), int(a), Query(q, y),
                    np.frombuffer(good, np.int64),
                )
            ]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in zip(*found)], names=names
                )

    names = [part.split()[0] for part in schema.split(", ")]
    return met.mapInArrow(released(run), schema)


def hard_negatives(
    rows: DataFrame,
    tables: Tables,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """``rows (vec_id, label, x)`` -> ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``; anchors have ids divisible by ``every``."""
    rows = tables.store(rows, "rows")
    count, d = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    size = width(d or 0)
    blocks = tables.store(vector_blocks(rows, size, max(1, -(-count // BLOCK))), "blocks")
    anchors = rows.where(F.col("vec_id") % every == 0).dropDuplicates()
    anchors = tables.store(anchors.withColumn("key", F.xxhash64("vec_id", "label", "x")), "asked")
    n = -(-anchors.count() // ANCHORS) or 1

    def best(rows, alike, key, a, q, _):
        ids, scores = nearest(alike[0], q, a, positives)
        return [(key, a, int(i), int(s)) for i, s in zip(ids, scores)]

    found = _meet(
        blocks, anchor_blocks(anchors.withColumn("goods", F.array().cast("array<bigint>")), size, n),
        tables, size, best, "key long, anchor_id long, positive_id long, positive_score long",
    )
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    chosen = tables.store(
        found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives),
        "positives",
    )
    goods = chosen.groupBy("key").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("nth", "positive_score"))),
            lambda x: x["positive_score"],
        ).alias("goods")
    )

    def hard(rows, alike, key, a, q, goods):
        others = alike[1] & (rows.ids != a)
        return [
            (key, nth, int(i), int(s))
            for nth, (ids, scores) in enumerate(in_bands(rows, q, others, goods, negatives), 1)
            for i, s in zip(ids, scores)
        ]

    met = _meet(
        blocks, anchor_blocks(anchors.join(goods, "key"), size, n), tables, size, hard,
        "key long, nth long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("key", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["key", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11(spark, sf_dir) -> DataFrame:
    rows = integers(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), Tables(spark))


OP11_SQL = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM clean a JOIN clean b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score,
    s.score AS negative_score,
    row_number() OVER (
      PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
  WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM ranked WHERE rank <= 10
"""
