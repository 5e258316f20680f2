"""Near-duplicates: MinHash bands, sequential Bayesian pruning, exact verification.

Documents are sets of 5-word shingles (64-bit hashes); two are linked if
``100 * intersection >= percent * union`` (85 in op4, 80 in the pipeline), groups are
connected components.

1. Signatures of ``BANDS * ROWS`` minima. Equal sets become one node, counted
   before the shuffle, so exact copies cost nothing further.
2. Nodes that share a band are candidates. The minima are split into
   bands by the limit: 30 of 6 rows at 85, 36 of 5 at 80 miss a pair at the limit with
   probability 7e-7.
3. A candidate's shingles that no other candidate has cannot be shared. What is
   left bounds every similarity exactly and discards most edited copies.
4. Each band bucket gives one pair per member, with the member of the fewest
   own shingles. Signatures of a pair are compared in batches of ``BATCH``
   minima; after each, the pair is dropped if its posterior chance to reach the
   limit is below ``MISS``. Survivors are verified on their full sets.
5. Components of these links. Candidates that hang together through buckets are
   a group; where a group still has several components, its members are compared
   across them in blocks of ``BLOCK``, pruned and verified in the task, which
   returns only links that join two components. So no such link is lost, pairs
   are never listed, and a group of any size is spread over tasks.

A null doc_id counts as the smallest id. Null, empty and wordless texts have no
shingle and no link. Repeated rows have equal ids and equal results. Empty
tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.joins import balanced_join
from .common import NO_ID, Tables, free_names, join_by_key, key_columns, released, sliced, table
from .wordhash import batches, mix, rolling, stream, whole, word_hashes

SHINGLE = 5
BANDS, ROWS = 30, 6
BATCH = 30
MISS = 1e-6
PIPELINE_PERCENT = 80
BLOCK = 400
U64 = np.uint64


def shingle_sets(texts: list[bytes]):
    """``(values, first)``: sorted distinct shingle hashes of each text, in a row."""
    texts = [t.lower() for t in texts]  # bytes: A-Z only
    (h,), first = word_hashes(texts)
    g, start = rolling(h, first, SHINGLE)
    doc = np.searchsorted(first, start, side="right") - 1
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        one = [whole(h[first[i] : first[i + 1]]) for i in short]
        g = np.concatenate([g, np.array(one, U64)])
        doc = np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minima per non-empty text: an array of ``(texts, BANDS * ROWS)`` 32-bit values."""
    n = np.diff(first)
    at = first[:-1][n > 0]
    out = np.zeros((len(n), BANDS * ROWS), np.uint32)
    if not len(at):
        return out
    for i, factor in enumerate(stream(BANDS * ROWS, 77)):
        values = (g * factor).view(np.uint32)[1::2]  # the high halves
        out[n > 0, i] = np.minimum.reduceat(values, at)
    return out


def _encoded(column) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _sketch(rows):
    """Batches of ``(d, k, text)`` -> ``d, k, n, s1, s2, sig``; s1, s2 identify the set."""
    for batch in sliced(rows):
        texts = _encoded(batch.column("text"))
        for lo, hi in batches(texts):
            g, first = shingle_sets(texts[lo:hi])
            n = np.diff(first)
            some = n > 0
            sums = []
            for seed in (1, 2):
                total = np.zeros(len(n), U64)
                if some.any():
                    mixed = mix(g ^ stream(1, 500 + seed)[0])
                    total[some] = np.add.reduceat(mixed, first[:-1][some])
                sums.append(mix(total + n.astype(U64)).view(np.int64))
            sig = signatures(g, first).astype("<u4")
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("d"), part.column("k"), pa.array(n, pa.int64()),
                    pa.array(sums[0]), pa.array(sums[1]),
                    pa.array([s.tobytes() if x else None for s, x in zip(sig, some)], pa.binary()),
                ],
                names=["d", "k", "n", "node", "s2", "sig"],
            )


def band_shape(percent: int) -> tuple[int, int]:
    """``(bands, rows)``: the widest bands that miss a pair at the limit in ``MISS`` at most."""
    minima = BANDS * ROWS
    for rows in range(ROWS, 1, -1):
        if not minima % rows and (1 - (percent / 100) ** rows) ** (minima // rows) <= MISS:
            return minima // rows, rows
    return minima, 1


def _bands(percent: int):
    """Batches of ``(node, sig)`` -> ``(key, node)``: one row per band."""
    bands, width = band_shape(percent)

    def run(rows):
        for batch in rows:
            nodes = batch.column("node").to_numpy()
            if not len(nodes):
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u4")
            sig = sig.reshape(len(nodes), bands, width).astype(U64)
            key = (sig * stream(width, 88)).sum(axis=2, dtype=U64)
            key = mix(key + np.arange(bands, dtype=U64) * U64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(nodes, bands))],
                names=["key", "node"],
            )

    return run


def _sets(rows):
    for batch in sliced(rows):
        texts = _encoded(batch.column("text"))
        for lo, hi in batches(texts):
            g, first = shingle_sets(texts[lo:hi])
            part = batch.slice(lo, hi - lo)
            sets = [g[a:b].astype("<u8").tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"]
            )


def _exploded(rows):
    for batch in rows:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            sets = part.column("shingles").to_pylist()
            nodes = np.repeat(part.column("node").to_numpy(), [len(s) // 8 for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(sets), "<i8")), pa.array(nodes)],
                names=["h", "node"],
            )


def least_matches(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """``(minima compared, matches needed)`` per batch.

    With a uniform prior the chance that the similarity reaches the limit t is
    P(Bin(n + 1, t) <= m) after m matches of n.
    """
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _prune(percent: int):
    """Batches of pairs with ``sig_a, sig_b`` -> the pairs that stay possible."""
    needed = least_matches(percent)

    def run(rows):
        for batch in sliced(rows):
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1)
                for c in ("sig_a", "sig_b")
            )
            left, matched = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            done = 0
            for n, least in needed:
                matched[left] += (a[left, done:n] == b[left, done:n]).sum(axis=1)
                left = left[matched[left] >= least]
                done = n
            yield batch.select(["a", "b"]).take(pa.array(left))

    return run


def _verify(percent: int):
    """Batches of pairs with both sets -> the pairs that are linked."""

    def run(rows):
        for batch in sliced(rows, 100):
            good = []
            for i, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return run


class _Links:
    """Prunes and verifies pairs of nodes; both sides of a pair may be hot."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int, tables: Tables):
        self.nodes, self.sets, self.percent, self.tables = nodes, sets, percent, tables
        self.n_sets = sets.count()

    def _with(self, pairs: DataFrame, side: DataFrame, column: str, names: tuple[str, str]):
        for end, name in zip(("a", "b"), names):
            right = side.select(F.col("node").alias(end), F.col(column).alias(name))
            # sets are wide: never broadcast, hot ends are salted
            pairs = balanced_join(
                pairs, right, [end], self.n_sets, broadcast_rows=0, rows_per_salt=20_000,
                big_counts=pairs.select(end).groupBy(end).agg(F.count("*").alias("n")),
            )
        return pairs.select("a", "b", *names)

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """``pairs (a, b)``, stored -> the linked ones, stored."""
        signed = self._with(pairs, self.nodes, "sig", ("sig_a", "sig_b"))
        likely = signed.mapInArrow(released(_prune(self.percent)), "a long, b long")
        likely = self.tables.store(likely, "likely")
        full = self._with(likely, self.sets, "shingles", ("set_a", "set_b"))
        linked = full.mapInArrow(released(_verify(self.percent)), "a long, b long")
        return self.tables.store(linked, "links")


def _possible(percent: int, x: str, y: str) -> str:
    """SQL: the shingles that others have leave the limit within reach."""
    both = f"least({x}.sh, {y}.sh)"
    return f"100 * {both} >= {percent} * ({x}.n + {y}.n - {both})"


def near_duplicates(docs: DataFrame, tables: Tables, percent: int = 85) -> DataFrame:
    """``docs (doc_id, text)`` -> ``_d, _k, n_shingles, component, comp`` per row; ``comp`` tells
    components apart whose least ids are equal or null, and is null for wordless texts."""
    d, k = key_columns()
    texts = docs.select(d.alias("d"), k.alias("k"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(released(_sketch), "d long, k long, n long, node long, s2 long, sig binary")
    rows = tables.store(rows, "sketches")
    nodes = (
        rows.where("n > 0").groupBy("node", "s2")
        .agg(F.min(F.struct("d", "k")).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .select("node", "n", "sig", F.col("least.d").alias("d"), F.col("least.k").alias("k"))
    )
    nodes = tables.store(nodes, "nodes")

    bands = tables.store(nodes.select("node", "sig").mapInArrow(released(_bands(percent)), "key long, node long"), "bands")
    shared = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    shared = tables.store(shared, "buckets")
    n_shared = shared.count()
    members = tables.store(balanced_join(bands, shared, ["key"], n_shared), "members")
    known = members.select("node").distinct()
    known = tables.store(nodes.join(known, "node", "left_semi").drop("sig"), "candidates")
    n_known = known.count()
    wanted = balanced_join(texts, known.select("d", "k", "node"), ["d", "k"], n_known)
    sets = tables.store(
        wanted.dropDuplicates(["node"]).select("node", "text").mapInArrow(released(_sets), "node long, shingles binary"), "sets"
    )

    # sh: the shingles of a node that some other candidate has as well
    own = sets.mapInArrow(released(_exploded), "h long, node long").groupBy("h").agg(
        F.count("*").alias("c"), F.min("node").alias("node")
    ).where("c = 1").groupBy("node").agg(F.count("*").alias("own"))
    sizes = known.join(own, "node", "left").selectExpr("node", "n", "n - coalesce(own, 0L) AS sh")
    # no partner can be more similar than sh / n
    sizes = tables.store(sizes.where(f"100 * sh >= {percent} * n"), "sizes")
    members = tables.store(balanced_join(members, sizes, ["node"], sizes.count()), "possible")

    links = _Links(nodes, sets, percent, tables)
    hub = F.struct("node", "n", "sh")
    hubs = members.groupBy("key").agg(
        F.min_by(hub, F.struct((F.col("n") - F.col("sh")) / F.col("n"), "node")).alias("hub")
    )
    hubs = tables.store(hubs.selectExpr("key", "hub.node", "hub.n", "hub.sh"), "hubs")
    joined = balanced_join(
        members.drop("m"), hubs.selectExpr("key", "struct(node, n, sh) AS hub"), ["key"], n_shared,
        broadcast_rows=50_000,
    )
    first = joined.select(F.struct("node", "n", "sh").alias("x"), "hub").where("x.node <> hub.node")
    first = first.where(_possible(percent, "x", "hub")).selectExpr(
        "least(x.node, hub.node) AS a", "greatest(x.node, hub.node) AS b"
    )
    tried = tables.store(first.distinct(), "pairs")
    found = links(tried)

    stars = joined.selectExpr("node AS a", "hub.node AS b").where("a <> b").distinct()
    groups = _labels(tables.store(stars, "stars"), tables).withColumnRenamed("comp", "group")
    apart = _apart(sizes, groups, _labels(found, tables), tables)
    if not apart.isEmpty():
        found = found.unionByName(_across(apart, nodes, sets, percent, links.n_sets))
        found = tables.store(found, "all")

    labels = _labels(found, tables)
    placed = nodes.select("node", "d").join(labels, "node", "left")
    placed = placed.select("node", "d", F.coalesce("comp", "node").alias("comp"))
    placed = tables.store(placed, "placed")
    least = tables.store(placed.groupBy("comp").agg(F.min("d").alias("component")), "least")
    placed = balanced_join(placed, least, ["comp"], least.count())
    placed = tables.store(placed.select("node", "component", "comp"), "components")
    keys = rows.select("d", "k", "n", "node")
    with_words = balanced_join(keys.where("n > 0"), placed, ["node"], placed.count())
    out = with_words.select("d", "k", "n", "component", "comp").unionByName(
        keys.where("n = 0").selectExpr("d", "k", "n", "d AS component", "CAST(NULL AS bigint) AS comp")
    )
    return out.selectExpr("d AS _d", "k AS _k", "n AS n_shingles", "component", "comp")


def _labels(links: DataFrame, tables: Tables) -> DataFrame:
    """``(node, comp)`` of the linked nodes."""
    if links.isEmpty():
        return links.selectExpr("a AS node", "b AS comp")
    work = _Work(tables)
    labels = connected_components(links.selectExpr("a AS src", "b AS dst"), work).labels
    return tables.store(labels.selectExpr("id AS node", "comp"), "labels")


class _Work:
    """The storage that ``connected_components`` expects, in this run's folder."""

    def __init__(self, tables: Tables):
        self.store = lambda df: tables.store(df, "graph")


def _apart(sizes: DataFrame, groups: DataFrame, comps: DataFrame, tables: Tables) -> DataFrame:
    """``(node, n, sh, comp, group, blocks)`` of the groups with several components."""
    placed = sizes.join(groups, "node").join(comps, "node", "left")
    placed = tables.store(placed.withColumn("comp", F.coalesce("comp", "node")), "placed")
    mixed = placed.groupBy("group").agg(
        F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")
    ).where("lo < hi").selectExpr("group", f"CAST(ceil(m / {BLOCK}) AS int) AS blocks")
    mixed = tables.store(mixed, "mixed")
    return tables.store(balanced_join(placed, mixed, ["group"], mixed.count()), "apart")


def _across(apart: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, n_sets: int):
    """Links between components of a group, from blocks of its members."""
    full = balanced_join(apart, nodes.select("node", "sig"), ["node"], n_sets, broadcast_rows=0)
    full = balanced_join(full, sets, ["node"], n_sets, broadcast_rows=0)
    full = full.withColumn("block", F.expr("CAST(pmod(xxhash64(node), blocks) AS int)"))
    columns = ["node", "n", "sh", "comp", "sig", "shingles"]
    x = full.select("group", F.col("block").alias("i"), F.expr("explode(sequence(block, blocks - 1)) AS j"), *columns)
    y = full.select(
        F.col("group").alias("y_group"), F.expr("explode(sequence(0, block)) AS y_i"),
        F.col("block").alias("y_j"),
        *[F.col(c).alias(f"y_{c}") for c in columns],
    )
    needed = least_matches(percent)

    def links(key, x, y):
        a, b = _compare(x, y.rename_columns(x.column_names), key[1] == key[2], percent, needed)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    left, right = x.groupBy("group", "i", "j"), y.groupBy("y_group", "y_i", "y_j")
    return left.cogroup(right).applyInArrow(links, "a long, b long")


def _compare(x: pa.Table, y: pa.Table, same: bool, percent: int, needed) -> tuple[list, list]:
    """Pairs of linked nodes of two blocks that join components not yet joined here."""
    if not x.num_rows or not y.num_rows:
        return [], []

    def numbers(t, c):
        return t[c].to_numpy()

    def sigs(t):
        return np.frombuffer(b"".join(t["sig"].to_pylist()), "<u4").reshape(t.num_rows, -1)

    xs, ys = numbers(x, "sh"), numbers(y, "sh")
    xn, yn, xc, yc = numbers(x, "n"), numbers(y, "n"), numbers(x, "comp"), numbers(y, "comp")
    xv, yv, a_sig, b_sig = numbers(x, "node"), numbers(y, "node"), sigs(x), sigs(y)
    pairs, weights = [], []
    for i in range(x.num_rows):
        both = np.minimum(xs[i], ys)
        open_ = (xc[i] != yc) & (100 * both >= percent * (xn[i] + yn - both))
        if same:
            open_ &= xv[i] < yv
        left = np.flatnonzero(open_)
        matched, done = np.zeros(len(left), np.int64), 0
        for n, least in needed:
            if not len(left):
                break
            matched = matched + (b_sig[left, done:n] == a_sig[i, done:n]).sum(axis=1)
            keep = matched >= least
            left, matched, done = left[keep], matched[keep], n
        pairs += [(i, j) for j in left.tolist()]
        weights += matched.tolist()
    parent: dict[int, int] = {}

    def find(c):
        while parent.get(c, c) != c:
            parent[c] = parent.get(parent[c], parent[c])
            c = parent[c]
        return c

    a_sets = [np.frombuffer(s, "<u8") for s in x["shingles"].to_pylist()]
    b_sets = [np.frombuffer(s, "<u8") for s in y["shingles"].to_pylist()]
    out = [], []
    for at in np.argsort(-np.array(weights, np.int64), kind="stable").tolist():  # likely links first
        i, j = pairs[at]
        p, q = find(int(xc[i])), find(int(yc[j]))
        if p == q:
            continue
        s, t = a_sets[i], b_sets[j]
        both = int((s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t).sum())
        if 100 * both >= percent * (len(s) + len(t) - both):
            parent[max(p, q)] = min(p, q)
            out[0].append(int(xv[i]))
            out[1].append(int(yv[j]))
    return out


def op4(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, Tables(spark))
    own = F.when(F.col("_d") != NO_ID, F.col("_d"))
    component = F.when(F.col("component") != NO_ID, F.col("component"))
    return found.select(
        own.alias("doc_id"), "n_shingles", component.alias("component_id"),
        (F.col("_d") == F.col("component")).alias("kept"),
    )


def drop_near_duplicates(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: of each group one document of the smallest id stays, and of equal
    wordless rows one."""
    tables = Tables(spark)
    found = near_duplicates(docs, tables, PIPELINE_PERCENT).where("_d = component").select("_d", "_k", "comp")
    found = tables.store(found, "kept")
    one = found.where("comp IS NOT NULL").groupBy("comp").agg(F.min(F.struct("_d", "_k")).alias("x"))
    kept = one.select("x._d", "x._k").unionByName(
        found.where("comp IS NULL").select("_d", "_k").distinct()
    )
    kept = tables.store(kept, "kept_keys")
    rows, _ = join_by_key(docs, kept, "left_semi")
    if not found.groupBy("_d", "_k").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        names = free_names(docs, "_d", "_k")  # equal rows: one of them stays
        rows = rows.withColumns(dict(zip(names, key_columns()))).dropDuplicates(names).drop(*names)
    return rows
