"""Quality rules with thresholds learned per language and source.

Every document gets integer measures; a mergeable quantile sketch per (language,
source) and measure gives the fences that replace fixed cutoffs. The sketch is
a histogram over buckets of bounded relative width (a power of two cut in 16):
counts merge by addition, in any order, so sketches of sources add up to those
of a language, a third of all rows in one source costs one row per bucket and
task, and a repeated run gives the same thresholds.

Groups below ``min_rows`` documents borrow the fences of their language, then
of all documents. A document is rejected when a measure lies beyond
``fence`` times the quartile distance above the upper quartile (word length:
on either side). Nothing but the sketches sets the fences: where a source's
quartiles coincide the fence is the quartile itself. Rates of short documents are
coarse, so a document's own count may exceed what the fence's rate allows by a few
events (``EVENTS``), whatever its source.

Null text: no words, base_failed. Null language or source: a group of its own.
Repeated rows each keep their row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.joins import balanced_join
from .common import SPACE_CHARS, Tables, words

SYMBOLS = "#*$%&|<>"
FENCE = 6
# (measure, least quartile distance, whether low values are judged as well). The least one
# is the sketch's own resolution there: a bucket's width around 500.
MEASURES = (
    ("word_length", 16, True),
    ("symbols", 0, False),
    ("dup_lines", 0, False),
    ("repeat_words", 0, False),
)
# (events, of what, spare): so many events beyond what the fence's rate allows are no verdict
EVENTS = {
    "symbols": ("n_symbols", "n_words", 3),
    "dup_lines": ("n_dup_lines", "n_lines", 5),
    "repeat_words": ("n_repeat_words", "n_words", 100),
}


def _fits(measure: str, both: bool, high: str, low: str) -> str:
    """SQL: the document lies within its group's fences (also DuckDB's)."""
    if measure in EVENTS:
        events, of, spare = EVENTS[measure]
        return f"1000 * {events} <= ({high}) * {of} + {1000 * spare}"
    fits = f"m_{measure} <= {high}"
    return f"{fits} AND m_{measure} >= {low}" if both else fits


def base_measures(docs: DataFrame) -> DataFrame:
    """Counts per document; one narrow pass, nothing leaves the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(
        F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""
    )
    first = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("lang"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source"),
        words(F.col("text")).alias("w"),
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    second = first.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(w) < 4 THEN CAST(array() AS array<bigint>) ELSE "
            "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END"
        ).alias("tri"),
    )
    # equal windows stand side by side once (hash, position) is sorted
    third = second.withColumn(
        "s",
        F.expr(
            "CASE WHEN size(array_distinct(tri)) = size(tri) "
            "THEN CAST(array() AS array<struct<h:bigint,p:int>>) "
            "ELSE array_sort(transform(tri, (h, i) -> named_struct('h', h, 'p', i))) END"
        ),
    ).drop("tri")
    fourth = third.withColumn(
        "p",
        F.expr(
            "array_sort(transform(filter(transform(s, (x, i) -> named_struct('p', x.p, 'twice', "
            "coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false))), "
            "x -> x.twice), x -> x.p))"
        ),
    ).drop("s")
    return fourth.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(p, named_struct('n', 0L, 'last', -3), (a, x) -> named_struct("
            "'n', a.n + least(3, x - a.last), 'last', x), a -> a.n)"
        ),
    ).drop("p")


def _measured(base: DataFrame) -> DataFrame:
    n = F.col("n_words")
    per = {
        "word_length": F.expr("word_chars * 100 DIV greatest(n_words, 1L)"),
        "symbols": F.expr("n_symbols * 1000 DIV greatest(n_words, 1L)"),
        "dup_lines": F.expr("n_dup_lines * 1000 DIV greatest(n_lines, 1L)"),
        "repeat_words": F.expr("n_repeat_words * 1000 DIV greatest(n_words, 1L)"),
    }
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return base.select(
        "*", failed.alias("base_failed"), *[e.alias(f"m_{m}") for m, e in per.items()]
    )


def sketch(measured: DataFrame) -> DataFrame:
    """``(lang, source, measure, bucket, n)``; '*' stands for all, levels merged."""
    rows = measured.selectExpr(
        "lang",
        "source",
        "stack(%d, %s) AS (measure, v)"
        % (len(MEASURES), ", ".join(f"'{m}', m_{m}" for m, _, _ in MEASURES)),
    )
    shift = "greatest(length(bin(v)) - 5, 0)"
    finest = (
        rows.selectExpr(
            "lang", "source", "measure",
            f"CAST({shift} * 16 + shiftright(v, {shift}) AS int) AS bucket",
        )
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )
    return (
        finest.selectExpr(
            "explode(array(named_struct('l', lang, 's', source), named_struct('l', lang, 's', "
            "'*'), named_struct('l', '*', 's', '*'))) AS g", "measure", "bucket", "n",
        )
        .groupBy(F.col("g.l").alias("lang"), F.col("g.s").alias("source"), "measure", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def fences(sketches: DataFrame, fence: int) -> DataFrame:
    """``(lang, source, rows, lo_*, hi_*)`` from the quartiles of each sketch."""
    group = Window.partitionBy("lang", "source", "measure")
    low = (
        "CASE WHEN bucket < 32 THEN CAST(bucket AS bigint) ELSE "
        "shiftleft(CAST(bucket - 16 * (bucket DIV 16 - 1) AS bigint), bucket DIV 16 - 1) END"
    )
    ranked = sketches.select(
        "lang", "source", "measure",
        F.expr(low).alias("v"),
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("rows"),
    )
    aggs = [F.max("rows").alias("rows")]
    for m, least, both in MEASURES:
        q1 = F.min(F.expr(f"CASE WHEN measure = '{m}' AND upto * 4 >= rows THEN v END"))
        q3 = F.min(F.expr(f"CASE WHEN measure = '{m}' AND upto * 4 >= 3 * rows THEN v END"))
        width = fence * F.greatest(q3 - q1, F.lit(least))
        aggs += [(q3 + width).alias(f"hi_{m}")]
        if both:
            aggs += [(q1 - width).alias(f"lo_{m}")]
    return ranked.groupBy("lang", "source").agg(*aggs)


def _resolved(thresholds: DataFrame, min_rows: int) -> DataFrame:
    """The fences of each (lang, source): its own, its language's or all documents'."""
    limits = [c for c in thresholds.columns if c[:3] in ("hi_", "lo_")]
    own = thresholds.where("source <> '*'")
    by_lang = thresholds.where("source = '*' AND lang <> '*'").selectExpr(
        "lang", "rows AS l_rows", *[f"{c} AS l_{c}" for c in limits]
    )
    overall = thresholds.where("lang = '*'").selectExpr(
        "1 AS one", *[f"{c} AS a_{c}" for c in limits]
    )
    joined = own.join(by_lang, "lang").withColumn("one", F.lit(1))
    joined = joined.join(F.broadcast(overall), "one")  # one row
    return joined.selectExpr(
        "lang",
        "source",
        *[
            f"CASE WHEN rows >= {min_rows} THEN {c} WHEN l_rows >= {min_rows} THEN l_{c} "
            f"ELSE a_{c} END AS {c}"
            for c in limits
        ],
    )


def quality_rules(
    docs: DataFrame, tables: Tables, min_rows: int = 50, fence: int = FENCE
) -> DataFrame:
    """``docs (doc_id, text, lang, source)`` -> counts, measures, fences and verdict."""
    measured = tables.store(_measured(base_measures(docs)), "measures")
    limits = tables.store(_resolved(fences(sketch(measured), fence), min_rows), "fences")
    judged = balanced_join(measured, limits, ["lang", "source"], limits.count())
    fits = " AND ".join(_fits(m, both, f"hi_{m}", f"lo_{m}") for m, _, both in MEASURES)
    return judged.withColumn("kept", F.expr(f"NOT base_failed AND {fits}"))


def op1(spark, sf_dir) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, Tables(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


_SPLIT = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
OP1_SQL = rf"""
WITH w AS (SELECT doc_id, '=' || lang AS lang, '=' || source AS source,
    coalesce(text, '') AS t, {_SPLIT.format('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    row_number() OVER () AS r FROM documents),
tri AS (SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM w)),
twice AS (SELECT r, p FROM tri JOIN (SELECT r, g FROM tri GROUP BY ALL HAVING count(*) > 1)
    USING (r, g)),
rep AS (SELECT r, count(DISTINCT p + o) AS n FROM twice, range(3) x(o) GROUP BY r),
b AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
    FROM w LEFT JOIN rep USING (r)),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars * 100 // greatest(n_words, 1) AS m_word_length,
    n_symbols * 1000 // greatest(n_words, 1) AS m_symbols,
    n_dup_lines * 1000 // greatest(n_lines, 1) AS m_dup_lines,
    n_repeat_words * 1000 // greatest(n_words, 1) AS m_repeat_words FROM b),
v AS (SELECT unnest([lang, lang, '*']) AS lang, unnest([source, '*', '*']) AS source,
    measure, v FROM (
    {' UNION ALL '.join(f"SELECT lang, source, '{m}' AS measure, m_{m} AS v FROM m"
                        for m, _, _ in MEASURES)})),
s AS (SELECT lang, source, measure, greatest(length(bin(v)) - 5, 0) AS sh, v FROM v),
k AS (SELECT lang, source, measure, sh * 16 + (v >> sh) AS bucket,
    (v >> sh) << sh AS v, count(*) AS n FROM s GROUP BY ALL),
c AS (SELECT lang, source, measure, v,
    sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, source, measure) AS rows FROM k),
f AS (SELECT lang, source, max(rows) AS rows, {', '.join(
    f"min(v) FILTER (measure = '{m}' AND upto * 4 >= rows) AS q1_{m}, "
    f"min(v) FILTER (measure = '{m}' AND upto * 4 >= 3 * rows) AS q3_{m}"
    for m, _, _ in MEASURES)} FROM c GROUP BY lang, source),
g AS (SELECT m.*, {', '.join(
    f"CASE WHEN o.rows >= 50 THEN o.{q}_{m} WHEN l.rows >= 50 THEN l.{q}_{m} "
    f"ELSE a.{q}_{m} END AS {q}_{m}" for m, _, _ in MEASURES for q in ('q1', 'q3'))}
    FROM m JOIN f o ON o.lang = m.lang AND o.source = m.source
    JOIN f l ON l.lang = m.lang AND l.source = '*' JOIN f a ON a.lang = '*')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(
    _fits(m, both, f"q3_{m} + {FENCE} * greatest(q3_{m} - q1_{m}, {least})",
          f"q1_{m} - {FENCE} * greatest(q3_{m} - q1_{m}, {least})")
    for m, least, both in MEASURES)} AS kept FROM g
"""
