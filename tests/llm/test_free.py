"""The operators that use Python in tasks, on hostile small inputs against brute force."""

import base64
import collections
import gzip
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pointcluster.llm import bpe, neardup, pii, substring, toxicity, warc
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
    clash = {"d": F.lit(1), "k": F.lit("x"), "node": F.lit(2), "ids": F.lit(0), "_d": F.lit(3)}
    return df.withColumns(clash).repartition(3)


def corpus(seed=5, n=120):
    """Copies, edited copies, shared passages, and hostile texts."""
    rng = random.Random(seed)
    vocabulary = ["w" + format(i, "x") for i in range(300)] + ["é", "Ü", "x"]

    def words(m):
        return [rng.choice(vocabulary) for _ in range(m)]

    passage, base = words(60), words(80)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE  two"), (5, "y" * 9000),
            (6, "same " * 400), (7, "same " * 300), (8, "1 2 3 4 5")]
    for i in range(10, n):
        kind = i % 5
        if kind == 0:
            w = words(rng.randint(1, 90))
        elif kind == 1:
            w = words(30) + passage[: rng.randint(8, 60)] + words(20)
        elif kind == 2:
            w = list(base)
        else:
            w = list(base)
            for _ in range(rng.randint(1, 6)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [rows[12], rows[13], (None, " ".join(base)), (None, "lonely null id")]
    return rows


# substring dedup ------------------------------------------------------------


def brute_substring(rows, window=13):
    key = [(-1 if i is None else i) for i, _ in rows]
    split = [(t or "").encode().split() for _, t in rows]
    least = {}
    for d, w in zip(key, split):
        for p in range(len(w) - window + 1):
            g = tuple(w[p : p + window])
            least[g] = min(d, least.get(g, d))
    out = []
    for (i, _), d, w in zip(rows, key, split):
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p : p + window])] < d:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [4 << 20, 2000])
def test_substrings(spark, tables, monkeypatch, chunk):
    monkeypatch.setattr(substring, "CHUNK_BYTES", chunk)
    rows = corpus()
    got = substring.dedup_substrings(frame(spark, rows), tables).drop("spans").collect()
    got = sorted([(r[0], r[1], r[2], bytes(r[3])) for r in got], key=repr)
    assert got == brute_substring(rows)


def test_substrings_of_nothing(spark, tables):
    empty = frame(spark, corpus()).limit(0)
    assert substring.dedup_substrings(empty, tables).count() == 0


# near-duplicates ------------------------------------------------------------


def brute_components(rows, percent=85, representatives=False):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = (t or "").translate(low).encode().split()
        sets.append({tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set())
    key = [(-1 if i is None else i) for i, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x in range(len(rows)):
        least[find(x)] = min(key[x], least.get(find(x), key[x]))
    if representatives:  # the least key of every component, one each
        return sorted(least.values())
    return {(key[x], len(sets[x]), least[find(x)]) for x in range(len(rows))}


def near(df, tables):
    rows = neardup.near_duplicates(df, tables).collect()
    fix = lambda v: -1 if v == neardup.NO_ID else v
    return {(fix(r["_d"]), r["n_shingles"], fix(r["component"])) for r in rows}


def test_near_duplicates(spark, tables):
    rows = corpus()
    assert near(frame(spark, rows), tables) == brute_components(rows)
    kept = neardup.drop_near_duplicates(spark, frame(spark, rows), None)
    # the stage takes pairs from 0.80
    want = brute_components(rows, 80, representatives=True)
    got = [-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()]
    assert sorted(got) == want and kept.columns == frame(spark, rows).columns


def test_one_row_stays_per_component(spark):
    """Unrelated texts without an id, or under one id, and wordless rows all stay."""
    texts = ["alone without any id at all", "another one of no id here", "a third one without its id"]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (None, ""), (None, " "), (None, None)]
    rows += [(7, "first text under this id seven"), (7, "wholly other words but same number"), (7, "")]
    rows += [(8, "first text under this id seven"), (7, "first text under this id seven")]
    kept = neardup.drop_near_duplicates(spark, frame(spark, rows), None)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(set(rows) - {(8, rows[7][1])}, key=repr)


def test_pipeline_takes_pairs_from_080(spark, tables):
    for percent, shape in ((85, (30, 6)), (80, (36, 5))):
        bands, rows = neardup.band_shape(percent)
        assert (bands, rows) == shape and (1 - (percent / 100) ** rows) ** bands < neardup.MISS
    rows = []
    for i in range(30):  # 96 shingles each: 86 of 106 are shared, then 84 of 108 (0.81, 0.78)
        words = [f"p{i}x{j}" for j in range(100)]
        rows.append((3 * i, " ".join(words)))
        rows.append((3 * i + 1, " ".join([*words[:90], *(f"q{i}x{j}" for j in range(10))])))
        rows.append((3 * i + 2, " ".join([f"r{i}x{j}" for j in range(12)] + words[12:])))
    assert near(frame(spark, rows), tables) == brute_components(rows)
    kept = {r["doc_id"] for r in neardup.drop_near_duplicates(spark, frame(spark, rows), None).collect()}
    want = {d for d, _, c in brute_components(rows, 80) if d == c}
    assert kept == want == {3 * i + j for i in range(30) for j in (0, 2)}


def test_near_duplicates_in_chains(spark, tables, monkeypatch):
    """Each text is near the next only, hubs do not reach far; blocks of two members."""
    monkeypatch.setattr(neardup, "BLOCK", 2)
    words = [f"t{i}" for i in range(160)]
    rows = [(50 - s, " ".join(words[4 * s : 4 * s + 100])) for s in range(12)]
    assert near(frame(spark, rows), tables) == brute_components(rows)


def test_nothing_near(spark, tables):
    assert near(frame(spark, corpus()).limit(0), tables) == set()
    rows = [(i, f"text {i} of its own words {i * 7} {i * 11}") for i in range(5)]
    assert near(frame(spark, rows), tables) == brute_components(rows)


def test_pruning_keeps_the_limit():
    """A pair at the limit passes each step but for the stated chance."""
    import math

    for n, least in neardup.least_matches(85):
        missed = sum(math.comb(n, m) * 0.85**m * 0.15 ** (n - m) for m in range(least))
        assert missed < 10 * neardup.MISS and least > n / 3


# tokens ---------------------------------------------------------------------


def reference_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        data = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(data, P.PATTERN), own


def test_codec_against_reference(monkeypatch):
    codec, own = reference_encoding()
    rng = random.Random(3)
    alphabet = " \n\t  abcdetheing'stß09!?.\x1c\x85\xa0漢字🎉#=-"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["", " ", "a" * 20000, "ab" * 9000, "=" * 7000, " " * 3000, "the" * 5000]
    texts += ["".join(rng.choice("thesingoraed") for _ in range(50000))]
    want = [b"".join(i.to_bytes(4, "little") for i in own.encode_ordinary(t)) for t in texts]
    assert codec.encode(texts) == want
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "FEW", 0)
    codec.new, codec.old = {}, {}
    assert codec.encode(texts[:400] + texts[3000:]) == want[:400] + want[3000:]
    assert [codec.decode(i) for i in want] == [t.encode() for t in texts]


def test_encoded_documents(spark, tables):
    _, own = reference_encoding()
    rows = corpus()
    got = bpe.digests(frame(spark, rows), bpe.default_tokenizer(spark)).collect()
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        data = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(data).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.digests(frame(spark, rows).limit(0), bpe.default_tokenizer(spark)).count() == 0


# WARC -----------------------------------------------------------------------


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({"sha1": F.lit("x"), "first_id": F.lit(0)}).repartition(4)


PAGES = [
    (5, "http://a", "<p>same</p>"), (3, "http://b\r\nX: 1", "<p>same</p>"), (9, None, "<p>same</p>"),
    (1, "u", None), (2, "u", ""), (7, "u", "é" * 70000), (8, "u", "".join(chr(32 + i * i % 90) for i in range(60000))),
    (10, "u", "once"), (10, "u", "once"), (None, "u", "<p>same</p>"), (None, "u", "no id"),
]


def test_warc_ranges_are_read_by_many_tasks(spark, tables):
    rows = [(i, "u", os.urandom(3000).hex()) for i in range(120)]
    archives = warc.archive_pages(pages(spark, rows).repartition(2), tables)
    size = sum(r["bytes"] for r in archives.collect())
    found = warc.read_archives(archives, split_bytes=size // 24)
    owners = found.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert found.rdd.getNumPartitions() >= 24 and len(owners) >= 10
    assert sum(r["n"] for r in owners) == len(rows)


@pytest.mark.parametrize("split", [97, 4 << 20])
def test_warc_round_trip(spark, tables, split):
    archives = warc.archive_pages(pages(spark, PAGES), tables)
    got = warc.read_archives(archives, split_bytes=split).collect()
    least = {}
    for i, _, h in PAGES:
        if i is not None:
            least[h or ""] = min(i, least.get(h or "", i))
    counts = collections.Counter(h or "" for _, _, h in PAGES)
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        first = least.get(h or "") if counts[h or ""] > 1 else i
        response = first is None or i == first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "response" if response else "revisit",
                     None if response else first, data if response else None))
    rows = [(r[0], r[1], r[2], r[3], r[4], None if r[6] is None else bytes(r[6])) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    # any gzip reader sees whole records
    for row in archives.collect():
        with gzip.open(row["path"].removeprefix("file://")) as file:
            assert file.read().count(b"WARC/1.1\r\n") == row["records"]


def test_warc_small_payloads_and_none(spark, tables):
    archives = warc.archive_pages(pages(spark, PAGES), tables, min_payload=12)
    got = warc.read_archives(archives, payloads=False).where("record_type = 'revisit'").collect()
    assert got == []
    empty = warc.archive_pages(pages(spark, PAGES).limit(0), tables)
    assert warc.read_archives(empty).count() == 0


def test_magic_by_chance_and_damage(tmp_path):
    inner = warc.record(1, "u", b"plain", "X", None, True)
    noise = os.urandom(500) + warc.MAGIC + os.urandom(300)
    good = [warc.record(i, "u", b"", "Y", 0, True) for i in range(3)]
    path = str(tmp_path / "a.warc.gz")
    with open(path, "wb") as file:
        file.write(noise + b"".join(good))
    assert len(list(warc.members(path, 0, 10**6))) == 3
    assert len(list(warc.members(path, len(noise) + 1, 10**6))) == 2
    with open(path, "wb") as file:
        file.write(good[0] + inner[:-5])
    with pytest.raises(ValueError):
        list(warc.members(path, 0, 10**6))


# PII ------------------------------------------------------------------------

PII_TEXTS = [
    None, "", "no data", "mail a.b+c@d-e.example.com, a@b, x@y.z@w.v", "1.2.3.4 256.1.1.1 1.2.3.4.5 01.02.03.004",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111111111111", "+1 (961) 555-6946 +12345 +" + "1" * 16,
    "0" * 6000 + ".1.1.1", "9" * 20000, "@" * 500, "a@" * 500, "." * 2000 + "@x.y", 'token = "5d190bd7c06284de91015a36"',
    "é 10.0.0.1\n10.0.0.2", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x" * 3000 + "@" + "y.z" * 50,
]


def brute_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p[-4000:]) > 255 or len(p.lstrip("0")) > 3 for p in m[0].split(".")):
                continue
            if kind == "card":
                odd = sum(int(c) for c in digits[-1::-2])
                even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
                if not 12 <= len(digits) <= 19 or (odd + even) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_base_spans():
    for text in PII_TEXTS:
        if text and len(text) > 10000:
            continue
        assert pii.find_spans(text, pii.Field())[0] == brute_spans(text), text and text[:60]
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice("019.@+- ()ab_%\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_field_learns_and_adds(spark, tables):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(32))
        kind = i % 4
        text = ["plain words only", f'set token = "{value}" now', f"call +1 ({i:03d}) 555-{i + 1000} soon",
                f"version {i}.{i % 7} of year 20{i % 90 + 10} done"][kind]
        rows.append((i, f"Some words before. {text} and after."))
    rows += [(1000 + i, t) for i, t in enumerate(PII_TEXTS)]
    df = frame(spark, rows)
    field = pii.train(df)
    got = {r["doc_id"]: r for r in pii.with_spans(df, field).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = [tuple(s) for s in got[i]["base"]]
        added = [tuple(s) for s in got[i]["added"]]
        assert base == brute_spans(text)
        assert not any(x < b and a < y for a, b, _ in added for x, y, _ in base)
        if i < 300:
            assert [k for _, _, k in added] == (["secret"] if i % 4 == 1 else []), text
    nothing = pii.train(df.limit(0))
    assert pii.find_spans("call 12345 or a 77", nothing) == ([], [])


def test_long_secrets_and_secrets_without_digits(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def text(i):
        long = "".join(rng.choice(letters + "0123456789._-") for _ in range(rng.randint(90, 400)))
        plain = "".join(rng.choice(letters) for _ in range(24))
        value = "x" + [long, plain][i % 2] + "x"
        return f"Some words before. set {['token =', 'secret:'][i // 2 % 2]} {value} and after.", value

    made = [text(i) for i in range(200)]
    rows = [(i, t) for i, (t, _) in enumerate(made)]
    rows += [(500 + i, f"Version {i}.{i % 7} is plain. The key: patience and time.") for i in range(100)]
    field = pii.train(frame(spark, rows))
    for t, value in made + [text(i) for i in range(20)]:
        assert (t.index(value), t.index(value) + len(value), "secret") in pii.find_spans(t, field)[1]
    assert pii.find_spans("The key: patience and time.", field) == ([], [])


# toxicity -------------------------------------------------------------------


def test_grammar_scores_clauses():
    s = toxicity.Scorer({"blurg": 3.0, "snar*": 3.0})
    best = lambda t: s.clauses(t)[0]
    assert best(None) == best("") == best("nothing here") == 0
    assert best("you are an IDIOT!!") > best("the idiot left.") > best("they said the idiot left.")
    assert best("he is not an idiot.") < best("an idiot.")
    assert best("I will kill you") > 0 and best("kill the lights") == 0
    assert best("I will not kill you") == 0
    assert best("blurg") == best("snarling") == 3.0 and best("sna") == 0
    assert s.clauses("idiot. idiot.\nidiot")[1] == 3
    assert s.score("x" * 100000) < 0.3 < s.score("you idiot, you worthless scum")


def test_toxicity_learns(spark, tables):
    rng = random.Random(4)
    plain = ["w" + str(i) for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            w.insert(rng.randrange(len(w)), "zorb" + rng.choice("abcdefgh") * 3)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(None, "zorbaaa"), (9000, None), (9001, "")]
    labels += [(None, 1), (3, None)]
    docs = frame(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    scorer = toxicity.train(docs, marks)
    got = toxicity.with_score(docs, scorer, "p").withColumn("held", toxicity.held_out()).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 600:
            assert (r["p"] >= 0.3) == (r["doc_id"] % 6 == 0)
    assert {r["held"] for r in got if r["doc_id"] is None} == {False}
    untrained = toxicity.train(docs.limit(0), marks)
    assert untrained.curve == toxicity.BASE
