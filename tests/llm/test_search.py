"""Hard negatives, tokenizer alignment and fingerprints against brute force."""

import collections
import hashlib
import itertools
import random
import re

import duckdb
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from pointcluster.llm import align, fingerprints, negatives
from pointcluster.llm.common import Tables, workers_find_package


@pytest.fixture(scope="module")
def tables(spark):
    workers_find_package(spark)
    made = Tables(spark)
    yield made
    made.close()


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = {"p": F.lit(1), "halo": F.lit("x"), "block": F.lit(2), "_d": F.lit(0), "f0": F.lit(3)}
    return df.withColumns(clash).repartition(3)


def corpus(seed=3, n=90):
    rng = random.Random(seed)
    words = ["word" + format(i, "x") for i in range(150)] + ["é", "Ü", "日本", "'s", "1234"]
    base = [rng.choice(words) for _ in range(70)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE two"), (5, "y" * 9000),
            (6, "same " * 400), (7, "a ▁ b"), (8, "x\x1c y \x85 z　w"), (9, "<s> </s>")]
    for i in range(10, n):
        w = list(base) if i % 3 else [rng.choice(words) for _ in range(rng.randint(1, 90))]
        if i % 3 == 1:
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i * 7, rng.choice([" ", "\n", "  "]).join(w)))
    return rows + [rows[20], rows[20], (None, "no id"), (None, "no id either"), (70, "id again")]


# -- fingerprints --------------------------------------------------------------


def spark_hash(values, seed=42):
    for v in values:
        data = v.encode() if isinstance(v, str) else (v[0] % 2 ** (8 * v[1])).to_bytes(v[1], "little")
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def brute_print(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    pairs = list(zip(w, w[1:])) if len(w) > 1 else [tuple(w)] if w else []
    terms = {spark_hash(p) & ~15 | min(15, sum(map(len, p))) for p in pairs}
    votes = [0] * 128
    for t in terms:
        for k in (0, 1):
            h = spark_hash([(t, 8), (k, 4)])
            for b in range(64):
                votes[64 * k + b] += (t & 15) * (1 if h >> b & 1 else -1)
    return tuple(sum(1 << b for b in range(64) if votes[64 * k + b] > 0) for k in (0, 1))


def brute_fingerprints(rows):
    def key(r):
        h = spark_hash([r[1]]) if r[1] is not None else 42
        return (-(2**63) if r[0] is None else r[0], h - 2**64 if h >= 2**63 else h)

    rows = sorted(rows, key=key, reverse=True)
    texts = [t or "" for _, t in rows]
    out = []
    for i, (d, _) in enumerate(rows):
        n, after = len(texts[i]), texts[(i + 1) % len(texts)]
        edited = texts[i][: n - n // 3] + after[: n // 3]
        a, b, c = brute_print(texts[i]), brute_print(edited), brute_print(after)
        like = [1 - sum((x ^ y).bit_count() for x, y in zip(a, o)) / 128 for o in (b, c)]
        out.append((d, n, hashlib.sha256(edited.encode()).hexdigest(),
                    "%016x%016x" % a, "%016x%016x" % b, *like))
    return out


def shown(rows):
    return sorted(map(tuple, rows), key=repr)


def test_fingerprints(spark, tables):
    rows = corpus()
    got = fingerprints.fingerprinted(frame(spark, rows), tables, every=5).collect()
    assert shown(r[:7] for r in got) == shown(brute_fingerprints(rows))
    prints = {t: brute_print(t or "") for _, t in rows}
    for r in got:
        if r.doc_id is None or r.doc_id % 5:
            assert r.n_within is None
            continue
        own = tuple(int(r.fingerprint[i : i + 16], 16) for i in (0, 16))
        near = [p for p in prints.values() if sum((a ^ b).bit_count() for a, b in zip(p, own)) <= 3]
        of_rows = [t for _, t in rows if prints[t] in near]
        assert (r.n_within, r.prints_within) == (len(of_rows), len(set(near)))


@pytest.mark.parametrize("radius, lead", [(3, 1), (5, 2), (2, 3)])
def test_radius_search_finds_all(spark, tables, monkeypatch, radius, lead):
    monkeypatch.setattr(fingerprints, "CHUNK", 4)  # crowded keys are cut
    rng = random.Random(radius)
    centers = [rng.getrandbits(128) for _ in range(4)]
    values = [c ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 5)))
              for c in centers for _ in range(40)] + centers[:1] * 30 + [0, 2**128 - 1]
    signed = [tuple((h - 2**64 if h >= 2**63 else h) for h in (v >> 64, v % 2**64)) for v in values]
    df = spark.createDataFrame(signed, "f0 long, f1 long")
    got = {(r.f0, r.f1): (r.n_rows, r.n_prints)
           for r in fingerprints.within_radius(df, df, tables, radius, lead).collect()}
    want = {}
    for v, s in zip(values, signed):
        near = [x for x in values if (x ^ v).bit_count() <= radius]
        want[s] = (len(near), len(set(near)))
    assert got == want


def test_fingerprints_of_few_or_no_documents(spark, tables):
    assert fingerprints.fingerprinted(frame(spark, []), tables).collect() == []
    one = fingerprints.fingerprinted(frame(spark, [(0, "abcdef")]), tables).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    equal = fingerprints.fingerprinted(frame(spark, [(None, "a b c")] * 40), tables).collect()
    assert len(equal) == 40 and {r.near_next for r in equal} == {1.0}


# -- alignment -------------------------------------------------------------------


def brute_alignment(rows):
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    chars = align._byte_of_char()
    per = []
    for d, text in rows:
        nothing = (d, 0, 0, 0, "", collections.Counter())
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            per.append(nothing)
            continue
        spans = [list(zip([0, *e], e)) for e in
                 (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))]
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, lo = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, (s, e) in zip(ids, sp) if lo <= s and e <= end)
                     for ids, sp in zip((ids_a, ids_b), spans)]
            groups.append("|".join(sides))
            lo = end
        links, j = collections.Counter(), 0
        for i, (s, e) in zip(ids_a, spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            for o in range(j, len(ids_b)):
                if spans[1][o][0] >= e:
                    break
                links[i, ids_b[o]] += 1
        per.append((d, len(ids_a), len(ids_b), len(groups),
                    hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    count = collections.Counter(p for r in per for p in r[5])
    best = collections.Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(d, na, nb, ng, sum(links.values()),
             sum(m for p, m in links.items() if count[p] == best[p[0]]),
             sum(m * count[p] for p, m in links.items()), digest)
            for d, na, nb, ng, digest, links in per], count


@pytest.mark.parametrize("block, piece", [(1_500_000, 1 << 16), (300, 40)])
def test_alignment(spark, tables, monkeypatch, block, piece):
    rows = [r if r[1] is None or len(r[1]) < 3000 else (r[0], r[1][:2500]) for r in corpus()]
    want, count = brute_alignment(rows)
    monkeypatch.setattr(align, "BLOCK_LINKS", block)
    monkeypatch.setattr(align, "PIECE_CHARS", piece)
    alignment = align.default_alignment(spark)
    aligner = align.Aligner(*alignment.files.value)
    assert aligner.cuts and aligner.encode_a.__name__ == "encode_ordinary"
    got = align.aligned(frame(spark, rows), alignment, tables).collect()
    assert shown(got) == shown(want)
    texts = [t for _, t in rows]
    small = [aligner.documents([t])[0] for t in texts]  # parts of 40 characters here
    assert shown(r[:4] for r in small) == shown((w[1], w[2], w[3], w[4]) for w in want)
    counts = align.pair_counts(alignment.blocks(frame(spark, rows))).collect()
    assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): r.n_docs for r in counts} == dict(count)


def test_alignment_of_very_long_and_no_texts(spark, tables):
    alignment = align.default_alignment(spark)
    assert align.aligned(frame(spark, []), alignment, tables).collect() == []
    long = [(1, "word " * 60_000), (2, "a" * 300_000), (3, " " * 200_000)]
    got = {r.doc_id: r for r in align.aligned(frame(spark, long), alignment, tables).collect()}
    assert got[1].n_groups == 60_001 and all(r.n_links > 0 for r in got.values())


def test_bitmaps():
    import numpy as np

    for size, docs in [(16, [3]), (1000, list(range(0, 1000, 2))), (65536, [0, 65535]), (8, [])]:
        packed = align.pack(np.array(docs, np.uint16), size)
        assert align.unpack(packed).tolist() == docs and align.popcount(packed) == len(docs)


# -- hard negatives ----------------------------------------------------------------


def vectors(n=600, d=64, seed=4):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centers[i % 6]
        v = [0.8 * a + 0.5 * rng.gauss(0, 1) for a in c]
        length = sum(x * x for x in v) ** 0.5
        rows.append((i, [x / length for x in v], i % 5))
    rows += [(n + i, rows[100][1], i % 3) for i in range(40)]  # copies: ties
    rows += [(9000, None, 1), (9001, [0.1] * d, None), (9100, [float("nan")] * d, 1),
             (9200, [0.5] * (d - 1) + [float("inf")], 2), (9300, [None] + [0.1] * (d - 1), 2),
             (9400, [0.0] * d, 3), (None, [0.2] * d, 3)]
    return rows


@pytest.mark.parametrize("d, block, anchors, limit", [(64, 4096, 1024, 1 << 25), (70, 64, 2, 0)])
def test_hard_negatives(spark, tables, monkeypatch, tmp_path, d, block, anchors, limit):
    for name, value in (("BLOCK", block), ("ANCHORS", anchors), ("BROADCAST_BYTES", limit)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(d=d)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({"x": F.lit(1), "key": F.lit("k"), "block": F.lit(2)}).repartition(3)
    path = str(tmp_path / "embeddings.parquet")
    df.write.parquet(path)
    got = negatives.op11(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute(negatives.OP11_SQL).fetchall()
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == sorted(want)


def test_intervals_hold_and_prune():
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(3000, 128))).astype(np.int64)
    x[:50] = x[0] + rng.integers(-20, 20, (50, 128))
    codes, c, r = negatives.code(x)
    rows = negatives.Rows(np.arange(3000), x, list(codes.T), c, r)
    for i in (0, 7, 100):
        guess, lower, upper = negatives.Query(x[i]).interval(rows)
        scores = x @ x[i]
        assert (lower <= scores).all() and (scores <= upper).all()
        assert (upper - lower < 2 * np.sqrt((x * x).sum(axis=1) * (x[i] @ x[i]))).all()
    assert (upper < scores.max()).mean() > 0.9


def test_hard_negatives_of_odd_tables(spark, tables):
    schema = "vec_id long, embedding array<double>, label int"

    def run(rows):
        df = negatives.integers(spark.createDataFrame(rows, schema))
        return sorted(map(tuple, negatives.hard_negatives(df, tables).collect()))

    assert run([]) == [] and run([(0, [1.0], 1)]) == []
    assert run([(0, [], 1), (1, [], 1), (2, [], 2)]) == [(0, 1, 1, 2, 0, 0)]
    # shorter vectors are padded; huge components are scored exactly
    rows = [(0, [2.0, 1.0], 1), (1, [2.0], 1), (2, [1.0, 0.5, 9.0], 2), (3, [-1.0], 3)]
    assert run(rows) == [(0, 1, 1, 2, 4 * 65536, 163840)]
    big = [(0, [2.0**19], 1), (1, [2.0**19], 1), (2, [2.0**18], 2)]
    assert run(big) == [(0, 1, 1, 2, 2**54, 2**53)]
    assert pd.DataFrame(run(big)).shape == (1, 6)
