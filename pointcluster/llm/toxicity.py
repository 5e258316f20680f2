"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer maps each word to a tag: insult, threat, target, negation,
reporting or other. Four small deterministic transducers then rewrite the tag
stream of a clause and weigh it: negation, reported speech, threat (a threat
word with a target near it) and insult (raised when it has a target). They are
composed into one machine; a clause is scored by its run, so a word counts by
the clause it stands in, not by itself. A logistic curve over the clause scores
of a text gives its score.

Insults are learned from the labelled rows: words and word beginnings whose
share of toxic texts is beyond chance, next to a short list of known words. At
most ``train_rows`` labelled rows are used (those of least hash, never a row
that is held out); at most ``max_terms`` terms are kept. Labels, language,
source and id are no input of a score.

Null and empty texts have no clause and get the base score. Without usable
labels the curve keeps its default. Rows are scored one by one, so repeated
rows, ties and extra columns play no part. Rows with several labels count as
toxic if one of them says so. A null doc_id has no label.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, released, sliced, table

OTHER, STOP, INSULT, THREAT, TARGET, NEGATION, REPORT = range(7)
# words known beforehand (fixed values)
KNOWN = {
    INSULT: "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumb filthy "
    "imbecile idiota estupido basura idioten dummkopf abschaum imbécile ordure",
    THREAT: "kill hurt destroy strangle stab shoot töten umbringen tuer matar",
    TARGET: "you your u they them he she him her his dich du ihr tu te vous ustedes",
    NEGATION: "not never no isn't aren't don't nicht kein nie pas jamais nunca",
    REPORT: "said says wrote claimed quoted told called sagte schrieb dit écrit dijo escribió",
}
KNOWN_WEIGHT = 2.0
PREFIXES = (4, 5, 6)
CLAUSE_END = ".!?;:"
REACH = 3  # tokens over which negation and targets work
BASE = (-4.0, 1.5, 1.0)  # curve without training: bias, best clause, number of clauses
MEMO = 100_000
EVIDENCE = 18.0  # nats by which a term's count must beat chance; about log(terms) + 4


class Transducer:
    """Deterministic: ``(state, tag) -> (state, tag, factor)``; other tags pass in ``default``."""

    def __init__(self, arcs: dict, default):
        self.arcs, self.default = arcs, default

    def step(self, state, tag):
        found = self.arcs.get((state, tag))
        if found is not None:
            return found
        return self.default(state), tag, 1.0

    def then(self, other: "Transducer", tags=range(7)) -> "Transducer":
        """The composition, over the states that can be reached."""
        arcs, todo, seen = {}, [(0, 0)], {(0, 0)}
        while todo:
            a, b = state = todo.pop()
            for tag in tags:
                a2, mid, f = self.step(a, tag)
                b2, out, g = other.step(b, mid)
                arcs[(state, tag)] = ((a2, b2), out, f * g)
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        index = {s: i for i, s in enumerate([(0, 0), *sorted(seen - {(0, 0)}, key=repr)])}
        return Transducer(
            {(index[s], t): (index[n], o, w) for (s, t), (n, o, w) in arcs.items()},
            lambda s: s,
        )


def _countdown(trigger: int, changes: dict) -> Transducer:
    """After ``trigger``, for ``REACH`` tokens, tags in ``changes`` become (tag, factor)."""
    arcs = {}
    for state in range(REACH + 1):
        arcs[(state, trigger)] = (REACH, trigger, 1.0)
        if state:
            for tag, (out, factor) in changes.items():
                arcs[(state, tag)] = (state - 1, out, factor)
    return Transducer(arcs, lambda s: max(s - 1, 0))


def grammar() -> Transducer:
    negation = _countdown(NEGATION, {INSULT: (INSULT, 0.2), THREAT: (OTHER, 0.0)})
    reported = Transducer(
        {
            (0, REPORT): (1, REPORT, 1.0),
            (1, INSULT): (1, INSULT, 0.5),
            (1, THREAT): (1, THREAT, 0.5),
        },
        lambda s: s,
    )
    targeted = _countdown(TARGET, {INSULT: (INSULT, 1.5)})
    # a threat word counts once a target follows it
    threat = Transducer(
        {
            **{(s, THREAT): (REACH, OTHER, 1.0) for s in range(REACH + 1)},
            **{(s, TARGET): (0, THREAT, 1.0) for s in range(1, REACH + 1)},
        },
        lambda s: max(s - 1, 0),
    )
    return negation.then(reported).then(targeted).then(threat)


class Scorer:
    """Lexicon, composed grammar and curve; small enough to travel with a task."""

    def __init__(self, terms: dict[str, float], curve=BASE):
        self.words = {w: (tag, KNOWN_WEIGHT) for tag, ws in KNOWN.items() for w in ws.split()}
        self.starts = {}
        for term, weight in terms.items():
            if term.endswith("*"):
                self.starts[term[:-1]] = weight
            else:
                self.words[term] = (INSULT, weight)
        self.curve = curve
        machine = grammar()
        states = 1 + max(s for s, _ in machine.arcs)
        self.next = [[machine.step(s, t) for t in range(7)] for s in range(states)]
        self.memo: dict[str, tuple] = {}

    def __getstate__(self):
        return {**self.__dict__, "memo": {}}

    def tag(self, word: str) -> tuple:
        """``(tag, weight, whether a clause ends here)`` of a white-space separated token."""
        lo, hi = 0, len(word)
        while lo < hi and not word[lo].isalpha():
            lo += 1
        while hi > lo and not word[hi - 1].isalpha():
            hi -= 1
        core, ends = word[lo:hi], any(c in CLAUSE_END for c in word[hi:])
        found = self.words.get(core)
        if found is None:
            weights = [self.starts[core[:n]] for n in PREFIXES if len(core) >= n and core[:n] in self.starts]
            found = (INSULT, weights[-1]) if weights else (OTHER, 0.0)  # the longest beginning
        out = (*found, ends)
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = out
        return out

    def clauses(self, text: str | None) -> tuple[float, int]:
        """``(best, matched)``: score of the best clause and number of matching clauses."""
        best, matched = 0.0, 0
        for line in (text or "").lower().split("\n"):
            tokens = line.split()
            memo = self.memo
            tags = [memo.get(w) or self.tag(w) for w in tokens]
            if not any(t[0] == INSULT or t[0] == THREAT for t in tags):
                continue
            state, total = 0, 0.0
            for tag, weight, ends in tags:
                state, out, factor = self.next[state][tag]
                if out == INSULT:
                    total += factor * weight
                elif out == THREAT:
                    total += factor * KNOWN_WEIGHT
                if ends:
                    if total > 0:
                        best, matched = max(best, total), matched + 1
                    state, total = 0, 0.0
            if total > 0:
                best, matched = max(best, total), matched + 1
        return best, matched

    def score(self, text: str | None) -> float:
        best, matched = self.clauses(text)
        z = self.curve[0] + self.curve[1] * math.log1p(best) + self.curve[2] * math.log1p(matched)
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """``(text, toxic)`` of at most ``train_rows`` labelled rows, none of them held out."""
    ids = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    )
    # train_rows bounds the broadcast: 12 bytes a row
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # copies of one text are one piece of evidence
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn_terms(rows: DataFrame, max_terms: int) -> dict[str, float]:
    """Words and beginnings (``abcd*``) that mark toxic texts beyond chance."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n, toxic = total["n"], total["t"]
    if not 0 < toxic < n:
        return {}
    base = toxic / n
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    starts = F.concat(
        *[
            F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.left(w, F.lit(k)), F.lit("*")))
            for k in PREFIXES
        ]
    )
    terms = rows.select("toxic", F.explode(F.array_distinct(F.concat(words, starts))).alias("term"))
    counts = (
        terms.where("term <> ''").groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
        .where("t >= 4 AND t > 0.8 * n")
    )
    # evidence: the count's divergence from the base rate, against as many tries as terms
    p = F.col("t") / F.col("n")
    odds = F.col("t") * F.log(p / base) + F.when(
        p < 1, (F.col("n") - F.col("t")) * F.log((1 - p) / (1 - base))
    ).otherwise(0.0)
    best = counts.select("term", "t", "n", odds.alias("odds")).where(f"odds > {EVIDENCE}")
    found = best.orderBy(F.desc("odds"), "term").limit(max_terms).collect()
    prior = math.log(base / (1 - base))
    words = {r["term"]: r["t"] for r in found if not r["term"].endswith("*")}
    starts: dict[str, int] = {}
    for word, t in words.items():
        for k in PREFIXES:
            starts[word[:k] + "*"] = max(t, starts.get(word[:k] + "*", 0))
    return {
        r["term"]: math.log((r["t"] + 0.5) / (r["n"] - r["t"] + 0.5)) - prior
        for r in found
        # a beginning that mostly stands for one word says nothing about others
        if starts.get(r["term"], 0) < 0.6 * r["t"]
    }


def _fit(x: np.ndarray, y: np.ndarray) -> tuple:
    """Logistic regression by Newton steps, lightly held to ``BASE``'s signs."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.array(BASE)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.01 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, max_terms: int = 5_000):
    rows = _training(docs, labels, train_rows)
    terms = learn_terms(rows, max_terms)
    scorer = Scorer(terms)

    def measure(batches):
        for batch in sliced(batches):
            found = [scorer.clauses(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "best": pa.array([b for b, _ in found], pa.float64()),
                "matched": pa.array([m for _, m in found], pa.int64()),
                "toxic": batch.column("toxic").cast(pa.int64()),
                "n": pa.array([1] * len(found), pa.int64()),
            })

    # at most train_rows rows of three numbers; equal ones are summed up first
    seen = rows.mapInArrow(released(measure), "best double, matched long, toxic long, n long")
    data = seen.groupBy("best", "matched", "toxic").agg(F.sum("n").alias("n")).collect()
    y = np.repeat([r["toxic"] for r in data], [r["n"] for r in data]).astype(float)
    if len(y) and 0 < y.sum() < len(y):
        x = np.log1p([[r["best"], r["matched"]] for r in data])
        scorer.curve = _fit(np.repeat(x, [r["n"] for r in data], axis=0), y)
    return scorer


def with_score(docs: DataFrame, scorer: Scorer, out: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` (0 to 1) in ``out``."""
    schema = docs.withColumn(out, F.lit(0.0)).schema

    def run(batches):
        for batch in sliced(batches):
            scores = [scorer.score(t) for t in batch.column("text").to_pylist()]
            yield batch.append_column(out, pa.array(scores, pa.float64()))

    return docs.mapInArrow(released(run), schema)


def op8(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return with_score(docs, scorer).select(
        "doc_id", held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def drop_toxic(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: documents with a score of 0.3 or more go."""
    scorer = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    (name,) = free_names(docs, "score")
    return with_score(docs, scorer, name).where(F.col(name) < 0.3).drop(name)
