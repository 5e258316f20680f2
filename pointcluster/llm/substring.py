"""Exact substring deduplication with fixed-block anchors.

A word goes if a window of ``window`` words over it also starts in a document of
smaller id. Blocks of ``(window + 1) // 2`` words, cut without overlap from
every document, are the index; every rolling window of that length is a probe.
Wherever two documents share a whole window, an index block of the one lies in
it, so the probes that hit a block of another document mark all places where a
repeat can be. Around them hits are extended: every full window that holds one
is compared exactly (128 bits per word sequence), and adjoining ones make up
the maximal repeats that are cut out.

Documents are dealt to chunks of ``CHUNK_BYTES`` of text by a hash, and a chunk
sends each distinct fingerprint once, packed by bucket: 32 bits beside the
bucket, as a false anchor only costs a comparison. So a passage in a third of all documents
costs one entry per chunk, and no task sees more than a bucket or a chunk.
Copies of a whole word sequence are settled beforehand by a hash, with counts
made before the shuffle. One shuffle of the texts serves all three passes.

Null, empty and short texts lose nothing. A null doc_id counts as the smallest.
Repeated rows have equal ids and keep each other. An empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import balanced_join
from .common import SPACE_CHARS, SPACES, Tables, key_columns, table
from .wordhash import batches, rolling, word_hashes

CHUNK_BYTES = 4 << 20
BUCKET_CHUNKS = 4
SEEDS = (0, 1)


def _hashes(texts: list[bytes], seeds=(0,)):
    """Word hashes per seed and the first word of each text, for a whole chunk."""
    parts, first, total = [[] for _ in seeds], [np.zeros(1, np.int64)], 0
    for lo, hi in batches(texts):
        h, at = word_hashes(texts[lo:hi], seeds)
        for p, x in zip(parts, h):
            p.append(x)
        first.append(at[1:] + total)
        total += at[-1]
    empty = np.empty(0, np.uint64)
    return [np.concatenate(p) if p else empty for p in parts], np.concatenate(first)


def _anchors(h, first, block: int, buckets: int):
    """``(bucket, fingerprint, start)`` of every rolling window of ``block`` words."""
    g, start = rolling(h, first, block)
    return (g >> np.uint64(32)) % np.uint64(buckets), g.astype(np.uint32), start


def _codes(bucket, print_):
    return (bucket << np.uint64(32)) | print_


class Chunk:
    """The rows of one chunk that are no copies of a smaller document's words."""

    def __init__(self, left: pa.Table, right: pa.Table):
        mine = right.filter(pc.equal(right["kind"], 0))
        copies = set(zip(mine["d"].to_pylist(), mine["k"].to_pylist()))
        self.d = left["d"].to_numpy()
        self.copy = [x in copies for x in zip(left["d"].to_pylist(), left["k"].to_pylist())]
        self.texts = [(t or "").encode() for t in left["text"].to_pylist()]
        self.live = [b"" if c else t for c, t in zip(self.copy, self.texts)]
        self.replies = {
            kind: b"".join(right.filter(pc.equal(right["kind"], kind))["data"].to_pylist())
            for kind in (1, 2)
        }


def _first_pass(chunk: Chunk, block: int, buckets: int):
    """Rows ``(bucket, data)``: sorted fingerprints and their flags (1: an index block,
    2: in several documents of the chunk)."""
    (h,), first = _hashes(chunk.live)
    bucket, print_, start = _anchors(h, first, block, buckets)
    if not len(start):
        return
    doc = np.searchsorted(first, start, side="right") - 1
    aligned = (start - first[doc]) % block == 0
    codes = _codes(bucket, print_)
    order = np.argsort(codes, kind="stable")
    codes, aligned, doc = codes[order], aligned[order], doc[order]
    at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    flags = np.maximum.reduceat(aligned, at).astype(np.uint8)
    flags |= (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)).astype(np.uint8) << 1
    codes = codes[at]
    which = (codes >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    for lo, hi in zip(cuts, [*cuts[1:], len(codes)]):
        yield int(which[lo]), codes[lo:hi].astype("<u4").tobytes() + flags[lo:hi].tobytes()


def _match_prints(chunks: list[int], datas: list[bytes], bucket: int):
    """Per chunk its fingerprints that are a block somewhere and in two documents."""
    keys = []
    for i, data in enumerate(datas):
        n = len(data) // 5
        prints = np.frombuffer(data, "<u4", n).astype(np.uint64)
        flags = np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64)
        keys.append((prints << np.uint64(32)) | np.uint64(i << 2) | flags)
    keys = np.sort(np.concatenate(keys))
    prints = keys >> np.uint64(32)
    at = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    count = np.diff(np.append(at, len(keys)))
    flags = np.bitwise_or.reduceat(keys & np.uint64(3), at)
    good = ((flags & np.uint64(1)) > 0) & ((count > 1) | ((flags & np.uint64(2)) > 0))
    keys = keys[np.repeat(good, count)]
    index = ((keys & np.uint64(0xFFFFFFFF)) >> np.uint64(2)).astype(np.int64)
    prints = keys >> np.uint64(32)
    order = np.argsort(index, kind="stable")
    index, prints = index[order], prints[order]
    codes = (np.uint64(bucket) << np.uint64(32)) | prints
    for i in np.unique(index):
        lo, hi = np.searchsorted(index, [i, i + 1])
        yield chunks[i], codes[lo:hi].astype("<u8").tobytes()


def _candidates(chunk: Chunk, window: int, block: int, buckets: int):
    """Windows that hold a hit: ``(start, doc, first, keys)`` with 128-bit keys."""
    (h, other), first = _hashes(chunk.live, SEEDS)
    bucket, print_, start = _anchors(h, first, block, buckets)
    hits = np.sort(np.frombuffer(chunk.replies[1], "<u8"))
    none = np.empty(0, np.int64)
    if not len(hits) or not len(start):
        return none, none, first, np.empty((0, 2), np.uint64)
    codes = _codes(bucket, print_)
    at = np.searchsorted(hits, codes)
    at[at == len(hits)] = 0
    hit = start[hits[at] == codes]
    # a hit at p lies in the windows that start in [p - (window - block), p]
    delta = np.zeros(len(h) + 2, np.int32)
    np.add.at(delta, np.maximum(hit - (window - block), 0), 1)
    np.add.at(delta, hit + 1, -1)
    a, at_a = rolling(h, first, window)
    b, _ = rolling(other, first, window, seed=1)
    chosen = np.cumsum(delta)[at_a] > 0
    starts = at_a[chosen]
    doc = np.searchsorted(first, starts, side="right") - 1
    return starts, doc, first, np.column_stack([a[chosen], b[chosen]])


def _groups(keys: np.ndarray, d: np.ndarray):
    """Sorted distinct keys, the smallest id of each, and the group of every row."""
    order = np.lexsort((d, keys[:, 1], keys[:, 0]))
    s = keys[order]
    new = np.append(True, (s[1:] != s[:-1]).any(axis=1)) if len(s) else np.empty(0, bool)
    group = np.empty(len(s), np.int64)
    group[order] = np.cumsum(new) - 1
    return s[new], d[order][new], group


def _second_pass(chunk: Chunk, window: int, block: int, buckets: int):
    """Rows ``(bucket, data)``: the chunk's distinct candidate windows, smallest id each."""
    _, doc, _, keys = _candidates(chunk, window, block, buckets)
    if not len(doc):
        return
    keys, least, _ = _groups(keys, chunk.d[doc])
    which = (keys[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(which, kind="stable")
    keys, least, which = keys[order], least[order], which[order]
    cuts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    for lo, hi in zip(cuts, [*cuts[1:], len(which)]):
        yield int(which[lo]), keys[lo:hi].astype("<u8").tobytes() + least[lo:hi].astype("<i8").tobytes()


def _match_windows(chunks: list[int], datas: list[bytes]):
    """Per chunk its windows that start in a smaller document of another chunk."""
    sizes = [len(x) // 24 for x in datas]
    keys = np.concatenate([np.frombuffer(x, "<u8", 2 * n).reshape(n, 2) for x, n in zip(datas, sizes)])
    d = np.concatenate([np.frombuffer(x, "<i8", n, 16 * n) for x, n in zip(datas, sizes)])
    _, least, group = _groups(keys, d)
    later = least[group] < d
    at = 0
    for c, n in zip(chunks, sizes):
        mine = keys[at : at + n][later[at : at + n]]
        at += n
        if len(mine):
            yield c, mine.astype("<u8").tobytes()


def _third_pass(chunk: Chunk, window: int, block: int, buckets: int):
    """``(n_words, n_removed, kept words, spans)`` per row of the chunk."""
    starts, doc, first, keys = _candidates(chunk, window, block, buckets)
    delta = np.zeros(first[-1] + window + 1, np.int32)
    if len(starts):
        distinct, least, group = _groups(keys, chunk.d[doc])
        elsewhere = np.frombuffer(chunk.replies[2], "<u8").reshape(-1, 2)
        known = {x.tobytes() for x in elsewhere}
        before = np.array([x.tobytes() in known for x in distinct], bool)
        gone = starts[before[group] | (chunk.d[doc] > least[group])]
        np.add.at(delta, gone, 1)
        np.add.at(delta, gone + window, -1)
    covered = np.cumsum(delta) > 0
    for i, text in enumerate(chunk.texts):
        words = text.split()  # bytes: ASCII white space, which is 0x20 and 0x09-0x0D
        if chunk.copy[i]:
            n = len(words) if len(words) >= window else 0
            yield len(words), n, b"" if n else b" ".join(words), [[0, n]] if n else []
            continue
        mask = covered[first[i] : first[i + 1]]
        if not mask.any():
            yield len(words), 0, b" ".join(words), []
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        spans = edge.reshape(-1, 2).tolist()
        kept = [w for w, m in zip(words, mask.tolist()) if not m]
        yield len(words), int(mask.sum()), b" ".join(kept), spans


def dedup_substrings(docs: DataFrame, tables: Tables, window: int = 13) -> DataFrame:
    """``docs (doc_id, text)`` -> ``doc_id, n_words, n_removed, kept, spans``: the words
    left, joined by a space, and the word ranges that went."""
    block = (window + 1) // 2
    text = F.col("text").cast("string")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).first()["b"]
    chunks = max(1, -(-size // CHUNK_BYTES))
    buckets = max(1, -(-chunks // BUCKET_CHUNKS))

    d, k = key_columns()
    rows = docs.select(
        d.alias("d"), k.alias("k"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    ).withColumn("chunk", F.pmod(F.xxhash64("k", "d"), F.lit(chunks)).cast("int"))
    bare = F.regexp_replace(F.btrim("text", F.lit(SPACE_CHARS)), SPACES, " ")
    copies = _copies(rows.select("d", "k", "chunk", F.unhex(F.md5(bare)).alias("seq")), tables)
    none = F.lit(b"").cast("binary")
    right = copies.select("chunk", F.lit(0).alias("kind"), "d", "k", none.alias("data"))

    def replies(df: DataFrame, kind: int) -> DataFrame:
        zero = F.lit(0).cast("long")
        return df.select("chunk", F.lit(kind).alias("kind"), zero.alias("d"), zero.alias("k"), "data")

    def sent(work):
        def run(key, left, right):
            out = list(work(Chunk(left, right), *args)) if left.num_rows else []
            return pa.table({
                "bucket": pa.array([b for b, _ in out], pa.int32()),
                "chunk": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "data": pa.array([x for _, x in out], pa.binary()),
            })

        args = (block, buckets) if work is _first_pass else (window, block, buckets)
        return rows.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(
            run, "bucket int, chunk int, data binary"
        )

    def matched(df: DataFrame, windows: bool) -> DataFrame:
        def run(key, t):
            args = (t["chunk"].to_pylist(), t["data"].to_pylist())
            out = list(_match_windows(*args) if windows else _match_prints(*args, key[0].as_py()))
            return pa.table({
                "chunk": pa.array([c for c, _ in out], pa.int32()),
                "data": pa.array([x for _, x in out], pa.binary()),
            })

        return df.groupBy("bucket").applyInArrow(run, "chunk int, data binary")

    right = right.unionByName(replies(matched(sent(_first_pass), False), 1))
    right = right.unionByName(replies(matched(sent(_second_pass), True), 2))

    def last(key, left, right):
        out = list(_third_pass(Chunk(left, right), window, block, buckets)) if left.num_rows else []
        return pa.table({
            "doc_id": left["doc_id"],
            "n_words": pa.array([x[0] for x in out], pa.int64()),
            "n_removed": pa.array([x[1] for x in out], pa.int64()),
            "kept": pa.array([x[2] for x in out], pa.binary()),
            "spans": pa.array([x[3] for x in out], pa.list_(pa.list_(pa.int64()))),
        })

    return rows.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(
        last,
        "doc_id long, n_words long, n_removed long, kept binary, spans array<array<bigint>>",
    )


def _copies(rows: DataFrame, tables: Tables) -> DataFrame:
    """Keys of documents whose word sequence a smaller document has."""
    rows = tables.store(rows.where("seq IS NOT NULL"), "sequences")
    least = rows.groupBy("seq").agg(F.min("d").alias("least"), F.max("d").alias("most"))
    least = tables.store(least.where("least < most").select("seq", "least"), "repeated")
    joined = balanced_join(rows, least, ["seq"], least.count())
    return tables.store(joined.where("d > least").select("chunk", "d", "k").distinct(), "copies")


def op5(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs, Tables(spark)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
