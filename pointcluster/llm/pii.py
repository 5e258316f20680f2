"""Personal data by patterns and a semi-Markov conditional random field.

Four patterns give the base spans. A semi-Markov field adds what they miss: it
scores whole candidate segments (shape, length, digits, checksum, the word
before) instead of single tokens, and dynamic programming over segments of at
most ``MAX_TOKENS`` white-space tokens chooses boundaries and types jointly.
Added spans never touch a base span.

Only tokens with a digit or an @, values assigned to a secret's name (without a digit:
quoted, after "=" or of 16 or more characters) and their neighbours can be in a segment, so
the text falls into islands; between them the best path is all "other" and the
program need not run. The field is trained on at most ``train_islands`` islands
of a hash sample of documents, with the patterns and the assignment of a quoted
value to a secret's name as labels, by stochastic gradient on the exact
likelihood (forward and backward sums over segments).

Kinds: email, ip, card, phone, and the field's own kind secret. Offsets are
code points, ends exclusive. Null and empty texts have no spans. Rows are
handled one by one, so repeated rows, ties and extra columns play no part.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, sliced, table

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    # a match begins where its digits begin: looking further on would only fail again
    "ip": re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
TRIGGER = re.compile(r"[0-9@]")
DIGIT = re.compile(r"[0-9]")
SECRET_NAMES = "token key secret password passwd pwd api_key apikey auth"  # fixed values
ASSIGNED = r"(?:" + "|".join(SECRET_NAMES.split()) + r")\s{0,3}[=:]\s{0,3}"
SECRET = re.compile(ASSIGNED + "$", re.I)
START = re.compile(r"[0-9@]|" + ASSIGNED + r"(?=\S)", re.I)
MAX_TOKENS = 4
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LEFT_TRIM = "\"'([{<*#$%&|!.,;:=>)]}-"
RIGHT_TRIM = "\"')]}>*#$%&|!.,;:=<([{-+"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches, found from each @ in linear time.

    A match begins with the earliest character of the run before the @ that no
    earlier match has taken, as a scan from the left would.
    """
    taken, at = 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > taken and text[lo - 1] in LOCAL_CHARS:
            lo -= 1
        domain = DOMAIN.match(text, at + 1) if lo < at else None
        if domain:
            taken = domain.end()
            yield lo, taken
        at = text.find("@", max(at + 1, taken))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the patterns, by start, then kind as listed."""
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in PATTERNS["ip"].finditer(text):
            parts = [g.lstrip("0") or "0" for g in m.groups()]
            if all(len(g) <= 3 and int(g) <= 255 for g in parts):
                found.append((m.start(), m.end(), "ip"))
        for m in PATTERNS["card"].finditer(text):
            digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() <= 40 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PATTERNS["phone"].finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def islands(text: str):
    """Runs of ``(start, end)`` tokens around the tokens with a digit or an @ and the values
    of a secret's name; a run takes in up to two tokens before each such token."""
    run: list[tuple[int, int]] = []
    last = 0  # end of the tokens already looked at
    for m in START.finditer(text):
        lo = m.start() if m.end() - m.start() == 1 else m.end()
        if lo < last:
            continue
        while lo > last and not text[lo - 1].isspace():
            lo -= 1
        hi = m.end()
        while hi < len(text) and not text[hi].isspace():
            hi += 1
        before = []
        at = lo
        while len(before) < 2 and at > last:
            while at > last and text[at - 1].isspace():
                at -= 1
            end = at
            while at > last and end - at < 40 and not text[at - 1].isspace():
                at -= 1
            if end == at or (at > last and not text[at - 1].isspace()):
                break
            before.append((at, end))
        if run and text[last : before[-1][0] if before else lo].strip():
            yield run
            run = []
        run += [*reversed(before), (lo, hi)]
        last = hi
    if run:
        yield run


def trimmed(text: str, lo: int, hi: int) -> tuple[int, int]:
    while lo < hi and text[lo] in LEFT_TRIM:
        lo += 1
    while hi > lo and text[hi - 1] in RIGHT_TRIM:
        hi -= 1
    return lo, hi


def features(text: str, lo: int, hi: int, before: str, tokens: int) -> list[str]:
    """Whole-span features of the segment ``text[lo:hi]``."""
    s = text[lo:hi]
    digits = DIGIT.findall(s)
    if len(s) > 80:
        return [
            f"long={min(len(s).bit_length(), 14)}", f"share={10 * len(digits) // len(s)}",
            f"tokens={tokens}", f"before={before}", f"long before={before}",
        ]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", s))
    mixed = len(re.findall(r"[0-9][A-Za-z]|[A-Za-z][0-9]", s))
    out = [
        f"shape={shape if len(shape) <= 16 else 'other'}",
        f"digits={min(len(digits), 20)}",
        f"size={min(len(s) // 4, 12)}",
        f"tokens={tokens}",
        f"mixed={min(mixed, 6)}",
        f"before={before}",
    ]
    if "@" in s:
        out.append("at")
    if s[:1] == "+":
        out.append("plus")
    if 12 <= len(digits) <= 19:
        out.append(f"luhn={luhn(''.join(digits))}")
    if shape == "9.9.9.9":
        out.append(f"bytes={all(len(p) < 4 and int(p) < 256 for p in s.split('.'))}")
    return out


def lattice(text: str, run: list[tuple[int, int]]):
    """``(i, j, lo, hi, features)``: candidate segments over tokens ``i`` to ``j`` of a run."""
    out = []
    for i in range(len(run)):
        gap = text[max(0, run[i][0] - 24) : run[i][0]]
        named = SECRET.search(gap)
        other = "word" if gap.strip() else "none"
        for j in range(i + 1, min(i + MAX_TOKENS, len(run)) + 1):
            lo, hi = trimmed(text, run[i][0], run[j - 1][1])
            if hi - lo < 5 or lo >= run[i][1] or hi <= run[j - 1][0]:
                continue
            if text.find("\n", lo, hi) >= 0:
                break
            digit = TRIGGER.search(text, lo, hi)
            plain = named and (
                "=" in named[0] or hi - lo >= 16 or text[lo - 1 : lo] in ("'", '"', "`")
            )
            if digit or plain and j == i + 1:
                before = "secret" if named and (digit or plain) else other
                out.append((i, j, lo, hi, features(text, lo, hi, before, j - i)))
    return out


class Field:
    """Weights per (feature, kind); "other" scores 0 per token."""

    def __init__(self, weights: dict[str, list[float]] | None = None):
        self.weights = weights or {}

    def scores(self, feats: list[str]) -> list[float]:
        total = [-3.0] * len(KINDS)  # a segment needs evidence
        for f in feats:
            w = self.weights.get(f)
            if w:
                for k, v in enumerate(w):
                    total[k] += v
        return total

    def decode(self, n: int, cands) -> list[tuple[int, int, str]]:
        """The best segmentation: ``(lo, hi, kind)`` of its segments."""
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        ending: dict[int, list] = {}
        for c in cands:
            s = self.scores(c[4])
            k = max(range(len(KINDS)), key=s.__getitem__)
            ending.setdefault(c[1], []).append((c, s[k], k))
        for j in range(1, n + 1):
            best[j], back[j] = best[j - 1], None
            for c, s, k in ending.get(j, ()):
                if best[c[0]] + s > best[j]:
                    best[j], back[j] = best[c[0]] + s, (c, k)
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                c, k = back[j]
                out.append((c[2], c[3], KINDS[k]))
                j = c[0]
        return out

    def learn(self, examples, epochs: int = 4, rate: float = 0.3) -> None:
        """Adaptive gradient ascent on the likelihood of labelled islands.

        ``examples``: ``(n, cands, gold)`` with ``gold`` = {candidate index: kind index}.
        """
        squares: dict[str, list[float]] = {}
        for _ in range(epochs):
            for n, cands, gold in examples:
                scores = [self.scores(c[4]) for c in cands]
                sums = [_logsum(s) for s in scores]
                starting, ending = {}, {}
                for x, c in enumerate(cands):
                    starting.setdefault(c[0], []).append(x)
                    ending.setdefault(c[1], []).append(x)
                ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
                for j in range(1, n + 1):
                    ahead[j] = _logsum(
                        [ahead[j - 1], *[ahead[cands[x][0]] + sums[x] for x in ending.get(j, ())]]
                    )
                for i in range(n - 1, -1, -1):
                    behind[i] = _logsum(
                        [behind[i + 1], *[sums[x] + behind[cands[x][1]] for x in starting.get(i, ())]]
                    )
                for x, c in enumerate(cands):
                    common = ahead[c[0]] + behind[c[1]] - ahead[n]
                    grad = [-math.exp(min(0.0, common + s)) for s in scores[x]]
                    if x in gold:
                        grad[gold[x]] += 1.0
                    if max(map(abs, grad)) < 1e-3:
                        continue
                    for f in c[4]:
                        w = self.weights.setdefault(f, [0.0] * len(KINDS))
                        q = squares.setdefault(f, [1e-6] * len(KINDS))
                        for k, g in enumerate(grad):
                            if g:
                                q[k] += g * g
                                w[k] += rate * g / math.sqrt(q[k])


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def example(text: str, run) -> tuple:
    """An island with its silver labels: base spans, and values assigned to a secret's name."""
    cands = lattice(text, run)
    lo, hi = run[0][0], run[-1][1]
    known = {(a, b): KINDS.index(k) for a, b, k in base_spans(text[lo:hi])}
    gold = {}
    for x, c in enumerate(cands):
        kind = known.get((c[2] - lo, c[3] - lo))
        if kind is None and c[1] - c[0] == 1 and "before=secret" in c[4]:
            kind = KINDS.index("secret")
        if kind is not None and not any(cands[y][0] < c[1] and c[0] < cands[y][1] for y in gold):
            gold[x] = kind
    return len(run), cands, gold


def train(docs: DataFrame, train_islands: int = 1500) -> Field:
    """A field trained on at most ``train_islands`` islands of a hash sample."""
    marked = docs.select("text").where(F.col("text").rlike("(?i)" + START.pattern))
    n = marked.count()
    share = min(1.0, 2.0 * train_islands / max(n, 1))
    sample = marked.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def cut(batches):
        for batch in sliced(batches):
            pieces = []
            for text in batch.column("text").to_pylist():
                for run in islands(text):
                    lo, hi = max(0, run[0][0] - 40), run[-1][1]
                    if hi - lo <= 400:
                        pieces.append(text[lo:hi])
            yield pa.RecordBatch.from_pydict({"piece": pa.array(pieces, pa.string())})

    # distinct pieces of at most 400 characters; train_islands bounds what the driver gets
    pieces = sample.mapInArrow(released(cut), "piece string").distinct()
    rows = pieces.orderBy(F.xxhash64("piece"), "piece").limit(train_islands).collect()
    field = Field()
    field.learn([example(r["piece"], run) for r in rows for run in islands(r["piece"])])
    return field


def find_spans(text: str | None, field: Field) -> tuple[list, list]:
    """``(base, added)`` spans of a text, each ``(start, end, kind)``."""
    if not text or not START.search(text):
        return [], []
    base, added = base_spans(text), []
    starts, ends = [], []  # the union of the base spans
    for a, b, _ in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for run in islands(text):
        for a, b, kind in sorted(field.decode(len(run), lattice(text, run))):
            at = bisect_left(starts, b)  # spans before this begin left of the segment's end
            if not at or ends[at - 1] <= a:
                added.append((a, b, kind))
    return base, added


def with_spans(docs: DataFrame, field: Field) -> DataFrame:
    """``docs (doc_id, text)`` -> ``doc_id, base, added``: arrays of (start, end, kind)."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def run(batches):
        for batch in sliced(batches):
            found = [find_spans(t, field) for t in batch.column("text").to_pylist()]
            sides = [
                pa.array([[dict(zip(("start", "end", "kind"), s)) for s in f[side]] for f in found],
                         pa.list_(span))
                for side in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *sides], names=["doc_id", "base", "added"]
            )

    kind = "array<struct<start:bigint,end:bigint,kind:string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(run), f"doc_id long, base {kind}, added {kind}"
    )


def _listed(spans: str) -> str:
    """SQL: spans by start, then kind as listed, as kind:start:end joined by commas."""
    order = ", ".join(f"'{k}'" for k in KINDS)
    return (
        f"array_join(transform(array_sort(transform({spans}, s -> named_struct('a', s.start, "
        f"'k', array_position(array({order}), s.kind), 's', s))), "
        "x -> concat_ws(':', x.s.kind, x.s.start, x.s.end)), ',')"
    )


def op6(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, train(docs))
    count = "CAST(size(filter(base, s -> s.kind = '{0}')) AS bigint) AS n_{0}"
    return found.selectExpr(
        "doc_id",
        *[count.format(k) for k in BASE],
        f"sha2({_listed('base')}, 256) AS base_sha256",
        f"{_listed('concat(base, added)')} AS spans",
    )
