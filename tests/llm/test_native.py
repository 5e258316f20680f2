"""The DataFrame-only operators on hostile small inputs, against plain Python."""

import hashlib
import re

import collections
import random

import pytest
from pyspark.sql import functions as F

from pointcluster.llm import chat, decontaminate, linededup, quality
from pointcluster.llm.common import NO_ID, Tables

TEXTS = [
    (1, "a b c a b c d " * 20),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "x" * 5000),
    (6, "same line\nsame line\n\nsame  line\nother # | <>"),
    (7, "the quick brown fox jumps over the lazy dog again and again " * 6),
    (7, "the quick brown fox jumps over the lazy dog again and again " * 6),
    (8, "é ü   ñ   z " * 30),
    (None, "no id here"),
]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else None, "s", "clash", 1.0) for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_words string, h double"
    ).repartition(3)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_base_measures(docs):
    want = []
    for i, t in TEXTS:
        w = split(t)
        tri = [tuple(w[p : p + 3]) for p in range(len(w) - 2)]
        twice = {p + o for p, g in enumerate(tri) if tri.count(g) > 1 for o in range(3)}
        lines = [x for x in (t or "").split("\n") if split(x)]
        want.append((
            i, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(twice),
        ))
    got = quality.base_measures(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_quality_verdicts(spark, docs):
    tables = Tables(spark)
    got = quality.quality_rules(docs, tables).select("doc_id", "kept", "base_failed").collect()
    assert len(got) == len(TEXTS) and not any(r["kept"] and r["base_failed"] for r in got)
    assert quality.quality_rules(docs.limit(0), tables).count() == 0
    tables.close()


def test_sketch_merges_and_learns(spark):
    """Junk of one source stands out from that source's own quartiles."""
    plain = spark.range(400).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 80), i -> concat('w', hash(id, i) % 997 + 2000))) AS text",
        "'en' AS lang", "IF(id < 200, 'a', 'b') AS source")
    noisy = plain.withColumn("text", F.expr("IF(doc_id % 40 = 0, replace(text, ' ', '###$$$ '), text)"))
    tables = Tables(spark)
    got = quality.quality_rules(noisy, tables).where("NOT kept").select("doc_id").collect()
    assert {r[0] for r in got} == set(range(0, 400, 40))
    tables.close()


def test_thresholds_follow_the_source(spark):
    """The same rate of symbols is normal in one source and junk in another."""
    text = "concat_ws(' ', transform(sequence(1, 100), i -> concat('w', hash(id, i) % 997 + 2000)))"
    some = f"IF(id % 2 = 0, concat({text}, repeat(' #', CAST(10 + id % 20 AS INT))), {text})"
    docs = spark.range(600).selectExpr(
        "id AS doc_id", f"CASE WHEN id < 200 THEN {some} WHEN id < 210 THEN concat({text}, repeat(' #', 25)) "
        f"WHEN id < 220 THEN concat({text}, repeat(' #', 3)) ELSE {text} END AS text",
        "'en' AS lang", "IF(id < 200, 'code', 'prose') AS source")
    tables = Tables(spark)
    limits = quality._resolved(quality.fences(quality.sketch(quality._measured(
        quality.base_measures(docs))), quality.FENCE), 50)
    high = {r["source"]: r["hi_symbols"] for r in limits.collect()}
    assert high["=prose"] == 0 and high["=code"] > 500
    got = quality.quality_rules(docs, tables).where("NOT kept").select("doc_id").collect()
    assert {r[0] for r in got} == set(range(200, 210))
    tables.close()


HOSTILE = [
    (1, 0, "system", "be </s> nice \\ [INST] <|im_end|>\n"),
    (1, 1, "user", None),
    (1, 2, "assistant", "</s>[INST] ok [/INST] \\n \\\\ <|im_start|>user\n"),
    (1, 3, "user", "<s><s<s>>"),
    (1, 4, "assistant", ""),
    (1, 4, "assistant", ""),
    (2, 0, "assistant", "first"),
    (3, 0, "user", "alone"),
    (4, 5, "user\nassistant\\", "odd role"),
    (4, 6, None, "no role"),
    (5, 1, "assistant", "x" * 20000),
    (None, 1, "assistant", "nobody"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(HOSTILE, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("formatted", F.lit(1)).repartition(3)
    examples = chat.format_chats(turns)
    for row in examples.collect():
        body = row["formatted"].replace("<|im_start|>", "").replace("<|im_end|>\n", "")
        assert not any(c in body for c in chat.CONTROL)
    got = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    convs = {}
    for c, t, r, x in HOSTILE:
        convs.setdefault(c, []).append((t, r or "", x or ""))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows.sort()
        whole = "".join(f"{r}\n{x}\n" for _, r, x in rows)
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert got[c]["n_turns"] == len(rows)
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = spark.createDataFrame(
        [(10, "Brown fox, jumps OVER the lazy dog again and again"), (11, "no id"), (12, None),
         (13, "!!"), (14, "over the"), (14, "over the")],
        "item_id long, text string",
    ).withColumn("doc_id", F.lit("clash"))

    def norm(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    want = []
    for i, t in TEXTS:
        w, hit, found = norm(t), set(), set()
        for item in items.collect():
            v = norm(item["text"])
            for s in range(max(len(v) - 9, 1) if v else 0):
                g = v[s : s + 10]
                for p in range(len(w) - len(g) + 1):
                    if w[p : p + len(g)] == g:
                        hit.update(range(p, p + len(g)))
                        found.add(str(item["item_id"]))
        want.append((i, len(w), len(hit), ",".join(sorted(found))))
    tables = Tables(spark)

    def run(docs, items):
        rows = decontaminate.decontaminate(docs, items, tables).collect()
        return sorted(
            [
                (None if r["_d"] == NO_ID else r["_d"], r["n"], r["n_hit"] or 0, ",".join(r["item_ids"] or []))
                for r in rows
            ],
            key=repr,
        )

    assert run(docs, items) == sorted(want, key=repr)
    assert [r[2:] for r in run(docs, items.limit(0))] == [(0, "")] * len(TEXTS)
    assert run(docs.limit(0), items) == []
    whole = decontaminate.BROADCAST_BYTES
    try:
        decontaminate.BROADCAST_BYTES = 64  # several blocks
        assert run(docs, items) == sorted(want, key=repr)
    finally:
        decontaminate.BROADCAST_BYTES = whole
    tables.close()


def test_decontamination_counts_shingles_in_all_documents(spark):
    frames = {}

    class Noted(Tables):
        def store(self, df, name="table"):
            frames[name] = super().store(df, name)
            return frames[name]

    passage = "a b c d e f g h i j"
    docs = spark.range(25_000).selectExpr(
        "id AS doc_id", f"concat('{passage} ', IF(id % 5 = 0, '{passage}', 'x y')) AS text"
    )
    items = spark.createDataFrame([("q", passage)], "item_id string, text string")
    tables = Noted(spark)
    try:
        hits, sizes = decontaminate.find_hits(docs, items, tables)
        assert hits.count() == 30_000 and sizes.count() == 25_000
        counts = [r["n"] for r in frames["rarity"].collect()]
        assert counts == [30_000] * 6
    finally:
        tables.close()


def test_decontamination_rows_do_not_carry_the_whole_text(spark):
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, None)], "doc_id long, text string")
    wanted = docs.limit(1).select(
        F.explode(F.expr("transform(slice(split(text, ' '), 101, 2), x -> xxhash64(1, xxhash64(x)))"))
        .alias("h")
    )
    for window in (None, 10):
        found = decontaminate._places(docs, wanted, [1], window)
        plan = found._jdf.queryExecution().executedPlan().toString()
        kept = re.findall(r"Generate explode\(.*\), \[([^\]]*)\], \w+, \[x#", plan)
        assert kept and all(re.findall(r"(\w+)#", k) == ["_d", "_k", "n"] for k in kept)
        rows = sorted(found.where("h IS NOT NULL").collect(), key=str)
        assert [(r["_d"], r["n"]) for r in rows] == [(1, 400)] * 2
        if window:
            assert sorted(r["p"] for r in rows) == [100, 101]
            for r in rows:
                at = r["p"] - r["shift"]
                assert r["around"] == words[at : at + 19] and r["around"][r["shift"]] == words[r["p"]]


def test_line_templates(spark):
    def body(i):
        return f"own line {chr(97 + i)} of it\nuser {i} logged in from host{i}\nAll rights reserved\nlast {chr(97 + i)}"

    rows = [(i, body(i)) for i in range(12)]
    rows += [(100 + i, body(0) + "\nextra") for i in range(20)]  # copies: one context
    rows += [(200, "All rights reserved"), (201, None), (202, ""), (203, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__l", F.lit(1))
    tables = Tables(spark)
    out = linededup.dedup_lines(docs, tables, min_docs=10)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert len(got) == len(rows) and out.columns[:3] == docs.columns
    for i in range(12):
        assert got[i] == f"own line {chr(97 + i)} of it\nlast {chr(97 + i)}"
    assert got[100] == "own line a of it\nlast a\nextra"
    assert got[200] == "" and got[201] is None and got[202] == "" and got[203] == "\n\n"
    assert linededup.dedup_lines(docs.limit(0), tables).count() == 0
    tables.close()


def letters(i):
    """A word of its own for every number, without digits."""
    return "".join(chr(97 + int(c)) for c in f"{i:07d}")


def deduped(spark, texts, **rules):
    tables = Tables(spark)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = linededup.dedup_lines(docs, tables, **rules).collect()
    tables.close()
    return [r["text"] for r in sorted(out, key=lambda r: r["doc_id"])]


def test_recurring_lines_with_fixed_neighbours(spark):
    block = "Home page here\nAbout this site\nContact the owner\nTerms of use"
    own = [f"{letters(i)} first own line\n{letters(i + 50)} second of them" for i in range(12)]
    more = [f"{letters(i + 100)} meht fo dnoces\n{letters(i + 150)} enil nwo tsrif" for i in range(12)]
    texts = [f"{block}\n{x}\n\nBetween two blanks\n\n{y}\n\nLast after blank" for x, y in zip(own, more)]
    # edited copies of one text stay copies
    lines = [f"{letters(900 + j)} line of a copied text" for j in range(10)]
    copies = []
    for i in range(30):
        part = list(lines)
        part[i % 10] = f"{letters(2000 + i)} edited in this copy"
        copies.append("\n".join(part))
    got = deduped(spark, texts + copies, copy_per_mille=linededup.COPY_PER_MILLE)
    assert got[:12] == [f"{x}\n\n\n{y}\n" for x, y in zip(own, more)]
    assert got[12:] == copies
    # without the rule distinct texts count, however alike they are
    assert deduped(spark, copies) == [f"{letters(2000 + i)} edited in this copy" for i in range(30)]


def test_menu_on_every_page(spark):
    menu = [f"{letters(j)} menu entry" for j in range(10)]
    pages = ["\n".join([*menu, f"{letters(100 + i)} {letters(300 + i)}"]) for i in range(200)]
    assert deduped(spark, pages) == [p.split("\n")[-1] for p in pages]


def test_long_lines_with_a_changed_word(spark):
    legal = [f"legal{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    own = [f"{letters(i)} own {letters(i + 90)}" for i in range(20)]
    texts = []
    for i, x in enumerate(own):
        line = list(legal)
        line[5 + 2 * i] = letters(500 + i)
        texts.append(f"{x}\n{' '.join(line)}")
    assert deduped(spark, texts) == own


def brute_lines(texts, min_docs=10, depth=3, most=24):
    """The rules of line templates, line by line."""
    def tokens(w):
        m = ["<*>" if any("0" <= c <= "9" for c in t) else t for t in w]
        if len(w) <= most:
            return tuple(m)
        rest = m[depth:]
        cut = [len(rest) * b // (most - depth) for b in range(most - depth + 1)]
        return (*m[:depth], *[tuple(rest[a:b]) for a, b in zip(cut, cut[1:])])

    lines = [(d, at, tokens(line.split()), len(line.split()))
             for d, t in enumerate(texts) for at, line in enumerate((t or "").split("\n")) if line.split()]
    leaf = {(t, n): (n, t[:depth]) for _, _, t, n in lines}
    of = collections.Counter(leaf[t, n] for _, _, t, n in lines)
    support = collections.Counter(
        (leaf[t, n], p, tok) for _, _, t, n in lines for p, tok in enumerate(t) if p >= depth
    )

    def templates(t, n):
        own, out = leaf[t, n], set()
        share = [1000 if p < depth else 1000 * support[own, p, tok] / of[own]
                 if support[own, p, tok] >= min_docs else -1 for p, tok in enumerate(t)]
        for least in linededup.SHARES_PER_MILLE:
            alike = sum(s >= least or tok == "<*>" for s, tok in zip(share, t))
            some = 1000 * alike >= linededup.SIMILAR_PER_MILLE * len(t)
            out.add(tuple(tok if s >= least else "<*>" for s, tok in zip(share, t)) if some else t)
        if 1000 * sum(s > 500 for s in share) >= linededup.MAJORITY_PER_MILLE * len(t):
            out.add(("majority", own))
        return out

    seen = collections.defaultdict(set)
    for d, _, t, n in lines:
        if of[leaf[t, n]] >= min_docs:
            for g in templates(t, n):
                seen[g].add(texts[d])
    drop = {(d, at) for d, at, t, n in lines if of[leaf[t, n]] >= min_docs
            and any(len(seen[g]) >= min_docs for g in templates(t, n))}
    return [t and "\n".join(x for at, x in enumerate(t.split("\n")) if (d, at) not in drop)
            for d, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_templates_against_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [letters(i) for i in range(40)]
    frames = ["you are at {} now", "{} wrote this on day 12{}", "sent by {} to {} and back", "all rights kept",
              "it is a {} {} {}", "see {}", "a b c " + "longer legal words " * 9 + "{} and the end of it {}"]
    texts = [None, "", "\n\n"]
    for _ in range(90):
        own = [rng.choice(frames) for _ in range(rng.randint(0, 5))]
        own = [f.format(*rng.choices(names, k=3)) for f in own]
        own += [" ".join(rng.choices(names, k=rng.randint(1, 40))) for _ in range(rng.randint(0, 3))]
        rng.shuffle(own)
        texts.append("\n".join(own))
    texts += texts[10:20] + texts[10:12]
    want = brute_lines(texts)
    assert sum(a != b for a, b in zip(texts, want)) > 30 and deduped(spark, texts) == want
    assert deduped(spark, []) == []


@pytest.mark.parametrize("n", [1_000, 100_000])
def test_fields_stay_fields_in_large_inputs(spark, n):
    """Two fields of 1,000 values each, beside a template of its own in the same leaf."""
    tables = Tables(spark)
    word = "translate(lpad(CAST({} % 1000 AS string), 3, '0'), '0123456789', 'abcdefghij')"
    docs = spark.range(n, numPartitions=4).selectExpr(
        "id AS doc_id",
        f"concat('the user named with ', {word.format('id')}, ' came in from the place of ', "
        f"{word.format('(id * 7 + id div 1000)')}, ' this very day now\\nown ', "
        "translate(CAST(id AS string), '0123456789', 'abcdefghij')) AS text",
    )
    out = linededup.dedup_lines(docs, tables)
    assert out.where("_dropped = 1 AND text RLIKE '^own [a-j]+$'").count() == n
    tables.close()


def test_long_lines_and_short_ones_with_fields(spark):
    notice = " ".join(f"legal{chr(97 + i % 26)}" for i in range(40))
    own = [f"{letters(i)} only here\n{letters(i + 50)} nor there {letters(i)} again" for i in range(12)]
    texts = [f"{x}\n{notice} {1990 + i}\npage was sent by {letters(i + 100)} to {letters(i + 200)} at night"
             f"\nwe are in {letters(i + 300)}" for i, x in enumerate(own)]
    assert deduped(spark, texts) == own


def test_stages_keep_all_columns(spark):
    """Columns named like the stages' own come back as they were."""
    import corpus_pipeline

    names = ["_d", "_k", "_r_d", "_r_k", "_l", "_rest", "_cut", "_lines", "_dropped", "score", "drop"]
    base = [(i, f"Some words of document {i} " * 30 + f"\nown line {i}\nAll rights reserved") for i in range(25)]
    base += [(25, None), (26, ""), (3, base[3][1]), (40, base[5][1])]
    docs = spark.createDataFrame(base, "doc_id long, text string")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert all(row[n] == f"{n}{row['doc_id']}" for n in names), name
    kept = corpus_pipeline.STAGES[2][1](spark, docs, None).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in kept} == {i: 1 for i in range(27)}
