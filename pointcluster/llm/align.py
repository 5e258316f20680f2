"""Cross-tokenizer alignment through inverted pair bitmaps.

Two tokenizers cut the same bytes. Where a token of A and one of B end at the same
byte, a group ends; inside, every A token is linked to the B tokens whose bytes it
shares. An id pair's count is the number of documents of the corpus that hold it linked.

Encoding. Both tokenizers are byte-exact, so token ends are running sums of token lengths
and links and groups come from searches in the two sorted lists of ends. A single space
between two characters that are not spaces always starts a token of both (``Aligner``
checks the vocabularies for it); long texts are encoded in parts cut there.

Index. Documents are taken in blocks of about ``BLOCK_LINKS`` pairs, numbered within the
block. For every id pair a block has a compressed bitmap of the documents that hold it
(sorted 16-bit numbers up to 1/16 of the block, plain bits beyond) and multiplicity
planes: bitmaps of the documents whose number of links has bit j set. Bitmaps of the
slices of a block are OR-merged. Blocks hold different documents, so the OR of a pair's
bitmaps over blocks is their union and its popcount the sum of theirs: popcounts add
up to document counts, and plane popcounts times 2^j to link counts.

Scores. Counts return to the blocks that asked, one row per block and pair, and the
block's postings hand them to documents: a document gets count times multiplicity for
every pair whose bitmap has its bit. Nothing is a row per document and pair.

Null and empty texts, and texts whose bytes a tokenizer changes, have no tokens: zeros,
and '' as digest. Repeated rows are documents of their own, also in the counts; null
ids stay null. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Tables, released, sliced, table

CUT = re.compile(r"(?<=\S) (?=\S)")
MARK = "▁"
PIECE_CHARS = 1 << 16
SIGNS = ";,|"
NOTHING = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
SLICE_ROWS = 250
BLOCK_LINKS = 1_500_000
BLOCK_DOCS = 1 << 16

BLOCK_SCHEMA = (
    "block long, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,"
    "n_links:bigint,groups_sha256:string>>, pairs array<bigint>, n_docs array<int>, "
    "n_links array<bigint>, bits array<binary>, planes array<array<binary>>"
)


def _byte_of_char() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 for itself, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# the pattern of byte-level pre-tokenizers (fixed value)
BYTE_LEVEL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _by_rank(told: dict, tokens: list[bytes]):
    """An encoder that merges by rank, six times as fast on one core, for vocabularies whose
    ids follow the order of their merges; None for others."""
    import tiktoken

    vocabulary, merges = told["model"]["vocab"], told["model"]["merges"]
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    special = {t["id"] for t in told.get("added_tokens", [])}
    if [vocabulary.get(m) for m in joined] != list(range(256, 256 + len(merges))):
        return None
    if sorted(vocabulary.values()) != list(range(256 + len(merges))) or told.get("normalizer"):
        return None
    ranks = {t: i for i, t in enumerate(tokens) if i not in special}
    return tiktoken.Encoding(
        "byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


class Aligner:
    """Both tokenizers, made from their files' bytes."""

    def __init__(self, a_json: bytes, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a_tokenizer = Tokenizer.from_str(a_json.decode("utf-8"))
        a_tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        chars = _byte_of_char()
        vocabulary = a_tokenizer.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in chars for c in token)
            self.a_bytes[i] = bytes(chars[c] for c in token) if known else token.encode()
        self.b_bytes = []
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces):
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace(MARK, " ").encode())
        told = json.loads(a_json)
        pre = told.get("pre_tokenizer") or {}
        split_a = pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        split_b = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.cuts = split_a and split_b
        self.encode_a = _by_rank(told, self.a_bytes) if split_a else None
        if self.encode_a is None:
            self.encode_a = lambda t: a_tokenizer.encode(t, add_special_tokens=False).ids
        self.a_lens = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_lens = np.array([len(t) for t in self.b_bytes], np.int64)
        self.size = max(len(self.a_bytes), len(self.b_bytes))
        self.shown = [f"{sign}{i}" for sign in SIGNS for i in range(self.size)]

    def pieces(self, text: str) -> list[str]:
        """Long texts in parts of about ``PIECE_CHARS``, cut only where both tokenizers do;
        every part stands behind one space."""
        if len(text) <= PIECE_CHARS or not self.cuts:
            return [text]
        out, lo = [], 0
        while len(text) - lo > PIECE_CHARS and (cut := CUT.search(text, lo + PIECE_CHARS)):
            out.append(text[lo : cut.start()])
            lo = cut.end()
        return [*out, text[lo:]]

    def documents(self, texts: list[str | None]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, digest, pairs, times)`` of each text."""
        cut = [self.pieces(t) if t else [] for t in texts]
        flat = [p for pieces in cut for p in pieces]
        found_a = [self.encode_a(" " + p) for p in flat]
        found_b = self.b.encode(flat, num_threads=1) if flat else []
        out, at = [], 0
        for text, pieces in zip(texts, cut):
            a, b = found_a[at : at + len(pieces)], found_b[at : at + len(pieces)]
            a = a[0] if len(a) == 1 else [x for f in a for x in f]
            b = b[0] if len(b) == 1 else [x for f in b for x in f]
            at += len(pieces)
            out.append(self.align((" " + text).encode(), a, b) if text else NOTHING)
        return out

    def align(self, whole: bytes, a: list[int], b: list[int]) -> tuple:
        """One text's columns; ``NOTHING`` if its bytes are not those of the tokens."""
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        if b"".join(map(a_bytes.__getitem__, a)) != whole:
            return NOTHING
        if b"".join(map(b_bytes.__getitem__, b)) != whole:
            return NOTHING
        ids_a, ids_b = np.fromiter(a, np.int64, len(a)), np.fromiter(b, np.int64, len(b))
        end_a, end_b = np.cumsum(self.a_lens[ids_a]), np.cumsum(self.b_lens[ids_b])
        # the first B token that ends beyond each A token's start, the last that starts before its end
        first = np.searchsorted(end_b, end_a - self.a_lens[ids_a], "right")
        last = np.searchsorted(end_b, end_a, "left")
        counts = last - first + 1
        begin = np.repeat(first - (np.cumsum(counts) - counts), counts)
        partner = begin + np.arange(len(begin))
        pairs, times = np.unique(np.repeat(ids_a, counts) << 32 | ids_b[partner], return_counts=True)
        # a group ends where an A token and a B token end together
        closes_a, closes_b = end_b[last] == end_a, np.isin(end_b, end_a, assume_unique=True)
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        opens_a = np.append(True, closes_a[:-1])
        opens_b = np.append(True, closes_b[:-1])
        signs_a = np.where(opens_a, SIGNS.index(";"), SIGNS.index(","))
        signs_b = np.where(opens_b, SIGNS.index("|"), SIGNS.index(","))
        signs = np.concatenate([signs_a, signs_b]) * self.size + np.concatenate([ids_a, ids_b])
        # A tokens of a group, then its B tokens: a stable sort by twice the group
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = "".join(map(self.shown.__getitem__, signs[order].tolist()))
        digest = hashlib.sha256(shown[1:].encode()).hexdigest()
        return len(a), len(b), int(closes_a.sum()), len(partner), digest, pairs, times


# -- bitmaps -------------------------------------------------------------------


def pack(docs: np.ndarray, size: int) -> bytes:
    """Sorted document numbers below ``size`` as a bitmap: first byte 0, then 16-bit
    numbers, or first byte 1, then bits."""
    if len(docs) * 16 <= size:
        return b"\0" + docs.astype("<u2").tobytes()
    bits = np.zeros(size, np.uint8)
    bits[docs] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpack(bitmap: bytes) -> np.ndarray:
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1).astype(np.int64)
    bits = np.frombuffer(bitmap, np.uint8, offset=1)
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def popcount(bitmap: bytes) -> int:
    if bitmap[0] == 0:
        return len(bitmap) // 2
    return int(np.bitwise_count(np.frombuffer(bitmap, np.uint8, offset=1)).sum())


class Block:
    """The inverted index of some documents, merged slice by slice."""

    def __init__(self):
        self.docs: list[dict] = []
        self.slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: list, found: list[tuple]) -> None:
        """One slice: its postings ordered by pair, then document."""
        first = len(self.docs)
        for doc_id, (n_a, n_b, n_groups, n_links, digest, _, _) in zip(ids, found):
            self.docs.append(
                {"doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                 "n_links": n_links, "groups_sha256": digest}
            )
        pairs = np.concatenate([f[5] for f in found])
        times = np.concatenate([f[6] for f in found])
        number = np.repeat(np.arange(first, first + len(found)), [len(f[5]) for f in found])
        order = np.argsort(pairs, kind="stable")
        self.slices.append(
            (pairs[order], number[order].astype(np.uint16), times[order].astype(np.int32))
        )
        self.size += len(pairs)

    def full(self) -> bool:
        return self.size >= BLOCK_LINKS or len(self.docs) + SLICE_ROWS > BLOCK_DOCS

    def row(self, block: int) -> dict:
        pairs = np.concatenate([s[0] for s in self.slices])
        order = np.argsort(pairs, kind="stable")  # the OR of the slices: numbers stay sorted
        pairs = pairs[order]
        number = np.concatenate([s[1] for s in self.slices])[order]
        times = np.concatenate([s[2] for s in self.slices])[order]
        edge = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.empty(0, int)
        ends = np.append(edge[1:], len(pairs))
        size = len(self.docs)
        most = np.maximum.reduceat(times, edge) if len(edge) else times
        bits, planes = [], []
        for lo, hi, top in zip(edge.tolist(), ends.tolist(), most.tolist()):
            own = number[lo:hi]
            bits.append(pack(own, size))
            # a pair linked once everywhere needs no planes
            planes.append(
                [] if top == 1 else
                [pack(own[times[lo:hi] >> j & 1 == 1], size) for j in range(top.bit_length())]
            )
        n_docs = [popcount(b) for b in bits]
        n_links = [
            sum(popcount(p) << j for j, p in enumerate(own)) if own else n
            for own, n in zip(planes, n_docs)
        ]
        return {
            "block": block, "docs": self.docs, "pairs": pairs[edge], "n_docs": n_docs,
            "n_links": n_links, "bits": bits, "planes": planes,
        }


def _arrow(row: dict) -> pa.RecordBatch:
    doc = pa.struct(
        [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
         ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
    )
    kinds = {
        "block": pa.int64(), "docs": pa.list_(doc), "pairs": pa.list_(pa.int64()),
        "n_docs": pa.list_(pa.int32()), "n_links": pa.list_(pa.int64()),
        "bits": pa.list_(pa.binary()), "planes": pa.list_(pa.list_(pa.binary())),
    }
    return pa.RecordBatch.from_arrays(
        [pa.array([row[n]], kind) for n, kind in kinds.items()], names=list(kinds)
    )


_aligners: dict[int, Aligner] = {}


def _aligner(a_json: bytes, b_model: bytes) -> Aligner:
    """One per worker and pair of files."""
    key = hash((a_json, b_model))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a_json, b_model)
    return _aligners[key]


class Alignment:
    """The index of a table of documents; the two files are read on the driver, once."""

    def __init__(self, spark: SparkSession, a_path: str, b_path: str):
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            self.files = spark.sparkContext.broadcast((a.read(), b.read()))

    def blocks(self, docs: DataFrame) -> DataFrame:
        """One row per block of documents, of bounded size: its documents, and the pairs
        with their bitmaps, planes and popcounts."""
        files = self.files

        def run(batches):
            from pyspark import TaskContext

            aligner = _aligner(*files.value)
            part, n, block = TaskContext.get().partitionId(), 0, Block()
            for batch in sliced(batches, SLICE_ROWS):
                texts = batch.column("text").to_pylist()
                block.add(batch.column("doc_id").to_pylist(), aligner.documents(texts))
                if block.full():
                    yield _arrow(block.row(part << 32 | n))
                    n, block = n + 1, Block()
            if block.docs:
                yield _arrow(block.row(part << 32 | n))

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return rows.mapInArrow(released(run), BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, n_docs, n_links, best)`` of every id pair of the corpus; ``best``: no
    other pair of its A id is held by more documents."""
    counts = (
        blocks.select(F.explode(F.arrays_zip("pairs", "n_docs", "n_links")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair"))
        .agg(F.sum("x.n_docs").alias("n_docs"), F.sum("x.n_links").alias("n_links"))
    )
    most = counts.groupBy(F.expr("shiftright(pair, 32)").alias("a")).agg(
        F.max("n_docs").alias("most")
    )
    return counts.withColumn("a", F.expr("shiftright(pair, 32)")).join(most, "a").select(
        "pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best")
    )


def scores(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document its columns in ``blocks``, ``n_best`` and ``count_sum``.

    A block asks for its pairs' counts by key; the answers come back as one array per
    block, as long as the block's list of pairs.
    """
    asked = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    answers = (
        asked.join(counts.select("pair", "n_docs", "best"), "pair")
        .groupBy("block")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("at", "n_docs", F.col("best").cast("long").alias("best")))
            ).alias("answers")
        )
        .select("block", "answers.n_docs", "answers.best")
    )
    joined = blocks.select("block", "docs", "bits", "planes").join(
        answers.withColumnsRenamed({"n_docs": "counts"}), "block", "left"
    )

    def run(batches):
        for batch in sliced(batches, 1):
            docs = batch.column("docs").to_pylist()[0]
            size = len(docs)
            total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            counts = batch.column("counts").flatten().to_numpy()
            is_best = batch.column("best").flatten().to_numpy()
            bits = batch.column("bits")[0].as_py()
            planes = batch.column("planes")[0].as_py()
            for count, top, bitmap, own in zip(counts, is_best, bits, planes):
                for j, plane in enumerate(own or [bitmap]):
                    if len(plane) > 1:
                        at = unpack(plane)
                        total[at] += count << j
                        if top:
                            best[at] += 1 << j
            out = pa.Table.from_pylist(docs)
            yield pa.RecordBatch.from_arrays(
                [
                    *[out.column(c).combine_chunks().cast(k) for c, k in (
                        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                        ("n_groups", pa.int64()), ("n_links", pa.int64()))],
                    pa.array(best), pa.array(total),
                    out.column("groups_sha256").combine_chunks(),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256"],
            )

    return joined.mapInArrow(
        released(run),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string",
    )


def default_alignment(spark: SparkSession) -> Alignment:
    import public_tokenizers

    return Alignment(
        spark,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def aligned(docs: DataFrame, alignment: Alignment, tables: Tables) -> DataFrame:
    """Alignment, counts and scores of every document."""
    blocks = tables.store(alignment.blocks(docs), "blocks")
    counts = tables.store(pair_counts(blocks), "counts")
    return scores(blocks, counts)


def op12(spark, sf_dir) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), default_alignment(spark), Tables(spark))
