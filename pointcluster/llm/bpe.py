"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges wait in one bucket per merge rank; a bucket lists positions in a linked
list of symbols. A bitmap of non-empty buckets, with bitmaps over its words on
top, gives the lowest rank by three find-first-set steps. An entry whose pair
has changed meanwhile is stale and skipped. Pre-tokens never merge with each
other, so one queue serves all new pre-tokens of a batch of texts: a bucket is
popped for all of them at once and its merges are applied as arrays. Within a
pre-token the order is the strict one (lowest rank, then leftmost): if a merge
made a pair of still lower rank, only the leftmost merge is applied before the
queue is asked again. The cost is near linear in the bytes, however long a
pre-token is.

Texts are cut into pre-tokens by the tokenizer's pattern. A single space
between two non-space characters always starts a pre-token, so texts are first
split there and results are kept per piece, in a cache of bounded size.

Null text: empty. No special tokens. Every row is encoded by itself, so
repeated rows, ties and extra columns play no part.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, sliced, table

NONE = np.int32(2**31 - 1)
CACHE_PIECES = 150_000
QUEUE_BYTES = 1 << 20
FEW = 16  # up to so many merges are applied one by one
CUT = re.compile(r"(?<=\S) (?=\S)")


class RankQueue:
    """Buckets by rank under a bitmap of 64-bit words, three levels deep."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (len(self.low) // 64 + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, positions) -> None:
        """``positions``: an array, or one place."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, np.ndarray] | None:
        if not self.top:
            return None
        a = (self.top & -self.top).bit_length() - 1
        b = a << 6 | (self.mid[a] & -self.mid[a]).bit_length() - 1
        rank = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        found = self.buckets.pop(rank)
        if len(found) == 1:
            return rank, np.atleast_1d(found[0])
        at = np.sort(np.concatenate([np.atleast_1d(x) for x in found]))
        return rank, at[np.append(True, at[1:] != at[:-1])]


class Codec:
    """Ranks of a vocabulary file (base64 bytes and rank per line) and a pattern."""

    def __init__(self, ranks_file: bytes, pattern: str):
        ranks = {}
        for line in ranks_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                if left is not None and (right := ranks.get(token[cut:])) is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        self.pairs = dict(zip(keys, values))
        order = np.argsort(keys)
        self.pair_keys = np.append(np.array(keys, np.int64)[order], 2**62)
        self.pair_ranks = np.append(np.array(values, np.int32)[order], NONE)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each non-empty pre-token as little-endian 32-bit integers."""
        lens = np.array([len(p) for p in pieces])
        n = int(lens.sum())
        word = np.repeat(np.arange(len(pieces)), lens)
        tok = np.append(self.byte[np.frombuffer(b"".join(pieces), np.uint8)], 0)
        # the place n stands for "nothing"; the links of pre-tokens end there
        nxt = np.append(np.arange(1, n + 1), n)
        prv = np.append(np.arange(-1, n - 1), n)
        ends = np.cumsum(lens)
        nxt[ends - 1] = n
        prv[ends - lens] = n
        rank_at = np.full(n + 1, NONE, np.int32)
        queue = RankQueue(self.size)

        def refresh(at: np.ndarray) -> None:
            right = nxt[at]
            found = np.where(right < n, self.pair_rank(tok[at], tok[right]), NONE)
            rank_at[at] = found
            good = found != NONE
            at, found = at[good], found[good]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for part, rank in zip(np.split(at, cuts), found[[0, *cuts]].tolist() if len(at) else ()):
                queue.push(rank, part)

        def refresh_one(p: int, left: int, q: int) -> int:
            rank = self.pairs.get(left * self.size + tok.item(q), NONE) if q < n else NONE
            rank_at[p] = rank
            if rank != NONE:
                queue.push(rank, p)
            return rank

        def one_by_one(rank: int, at: list[int]) -> None:
            for i, p in enumerate(at):
                if rank_at.item(p) != rank:
                    continue  # stale
                gone = nxt.item(p)
                q, o = nxt.item(gone), prv.item(p)
                tok[p], tok[gone], rank_at[gone], nxt[p] = rank, -1, NONE, q
                if q < n:
                    prv[q] = p
                lower = refresh_one(p, rank, q) < rank
                if o < n:
                    lower |= refresh_one(o, tok.item(o), p) < rank
                if lower:
                    for later in at[i + 1 :]:
                        queue.push(rank, later)
                    return

        refresh(np.arange(n))
        while (popped := queue.pop()) is not None:
            rank, at = popped
            if len(at) <= FEW:
                one_by_one(rank, at.tolist())
                continue
            at = at[rank_at[at] == rank]  # the others are stale
            if not len(at):
                continue
            # of overlapping pairs every second one, counted from the left
            index = np.arange(len(at))
            joined = np.append(False, nxt[at[:-1]] == at[1:])
            run = np.maximum.accumulate(np.where(joined, 0, index))
            at = at[(index - run) % 2 == 0]
            at = self._in_order(rank, at, word, tok, nxt, prv, n, queue)
            gone = nxt[at]
            after = nxt[gone]
            tok[at] = rank
            nxt[at] = after
            prv[after] = at
            tok[gone] = -1
            rank_at[gone] = NONE
            prv[n], nxt[n] = n, n
            before = prv[at]
            touched = np.sort(np.concatenate([at, before[before < n]]))
            refresh(touched[np.append(True, touched[1:] != touched[:-1])])
        left = tok[:-1] >= 0
        ids = tok[:-1][left].astype("<u4")
        counts = np.bincount(word[left], minlength=len(pieces))
        data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _in_order(self, rank, at, word, tok, nxt, prv, n, queue):
        """Of the merges ``at``, those that may be applied at once: all of a pre-token's,
        or its leftmost if one of them makes a pair of lower rank."""
        w = word[at]
        first = np.append(True, w[1:] != w[:-1])
        if first.all():
            return at
        made = np.full(len(at), rank, np.int64)
        before, after = prv[at], nxt[nxt[at]]
        follows = np.append(False, nxt[at[:-1]] == before[1:])
        left = np.where(before < n, self.pair_rank(np.where(follows, rank, tok[before]), made), NONE)
        right = np.where(after < n, self.pair_rank(made, tok[after]), NONE)
        lower = np.minimum(left, right) < rank
        if not lower.any():
            return at
        wait = ~first & np.isin(w, w[lower])
        # pairs that overlapped with a waiting one come back as new entries later
        queue.push(rank, at[wait])
        return at[~wait]

    def pieces(self, text: str) -> list[str]:
        """Keys of the pieces: the text's first one with a space in front; for the
        others, whose text begins with a space, without that space."""
        cut = text.split(" ")
        if "" in cut or list(map(str.strip, cut)) != cut:  # other white space beside a space
            cut = CUT.split(text)
        cut[0] = " " + cut[0]
        return cut

    def learn(self, pieces) -> None:
        """Encode pieces that are not cached, in batches of bounded bytes."""
        todo = list(pieces)
        for lo in range(0, len(todo), CACHE_PIECES):
            found = {
                p: self.pattern.findall(p[1:] if p[0] == " " else " " + p)
                for p in todo[lo : lo + CACHE_PIECES]
            }
            distinct = list({m for ms in found.values() for m in ms})
            ids, at = {}, 0
            while at < len(distinct):
                size, to = 0, at
                while to < len(distinct) and (to == at or size + len(distinct[to]) <= QUEUE_BYTES):
                    size += len(distinct[to])
                    to += 1
                part = distinct[at:to]
                ids.update(zip(part, self.merge([m.encode() for m in part])))
                at = to
            for p, ms in found.items():
                self.new[p] = ids[ms[0]] if len(ms) == 1 else b"".join([ids[m] for m in ms])

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        lo = 0
        while lo < len(texts):
            hi, size, unknown = lo, 0, {}
            if len(self.new) > CACHE_PIECES:
                self.old, self.new = self.new, {}
            new, old = self.new, self.old
            while hi < len(texts) and (hi == lo or (len(unknown) < CACHE_PIECES // 2 and size < 8 << 20)):
                for p in set(self.pieces(texts[hi])):
                    if p not in new:
                        if p in old:
                            new[p] = old[p]
                        else:
                            unknown[p] = None
                size += len(texts[hi])
                hi += 1
            self.learn(unknown)
            out += [b"".join(map(new.__getitem__, self.pieces(t))) for t in texts[lo:hi]]
            lo = hi
        return out

    def forget(self) -> None:
        """Empty the cache: a worker outlives its task."""
        self.new, self.old = {}, {}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(ranks_file: bytes, pattern: str) -> Codec:
    key = (hash(ranks_file), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks_file, pattern)
    return _codecs[key]


class Tokenizer:
    """The codec on the executors; the vocabulary file (under 2 MB) is broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            self.file = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        """``docs`` with ``ids``: binary, little-endian unsigned 32-bit integers."""
        file, pattern = self.file, self.pattern
        schema = docs.withColumn(ids, F.lit(b"")).schema

        def run(batches):
            codec = _codec(file.value, pattern)
            for batch in sliced(batches, 1000):
                texts = [t or "" for t in batch.column(text).to_pylist()]
                yield batch.append_column(ids, pa.array(codec.encode(texts), pa.binary()))
            codec.forget()

        return docs.mapInArrow(released(run), schema)

    def round_trip(self, docs: DataFrame) -> DataFrame:
        """``doc_id, ids, decoded`` in one pass of one worker: the ids of ``text``, and the
        bytes those ids stand for."""
        file, pattern = self.file, self.pattern

        def run(batches):
            codec = _codec(file.value, pattern)
            for batch in sliced(batches, 1000):
                ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(ids, pa.binary()),
                        pa.array([codec.decode(i) for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "ids", "decoded"],
                )
            codec.forget()

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return rows.mapInArrow(released(run), "doc_id long, ids binary, decoded binary")

    def decode(self, docs: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """``docs`` with ``out``: the bytes that ``ids`` stand for; null gives none."""
        file, pattern = self.file, self.pattern
        schema = docs.withColumn(out, F.lit(b"")).schema

        def run(batches):
            codec = _codec(file.value, pattern)
            for batch in sliced(batches, 1000):
                found = [codec.decode(i or b"") for i in batch.column(ids).to_pylist()]
                yield batch.append_column(out, pa.array(found, pa.binary()))

        return docs.mapInArrow(released(run), schema)


def default_tokenizer(spark: SparkSession) -> Tokenizer:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return Tokenizer(spark, path, public_tokenizers.PATTERN)


def digests(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    return tokenizer.round_trip(docs).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9(spark, sf_dir) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_tokenizer(spark))


def encode_stage(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: token counts and digests of every document."""
    return digests(docs, default_tokenizer(spark))
