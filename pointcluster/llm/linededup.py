"""Line deduplication with a log-template tree.

Lines are parsed as log lines are: the tree's first level is the token count,
the next ``depth`` levels the leading tokens (those with a digit count as the
variable ``<*>``), and lines meet in the leaf they reach. In a leaf a token
that at least ``min_docs`` lines have at its place is part of the template, any
other is a variable field; so that a field's values do not become constant as the
input grows, every line has further templates, in which a constant token must have a
share of ``SHARES_PER_MILLE`` of the leaf's lines as well. A line of which less than
``SIMILAR_PER_MILLE`` is constant is its own template. Lines that agree with the majority
of their leaf at ``MAJORITY_PER_MILLE`` of all places also share one template, wherever
they differ. Lines of which any template recurs in ``min_docs`` or more documents are dropped everywhere.

A document counts for a template once, whatever lines stand around it. Exact copies
count as one text. Where ``copy_per_mille`` is given (the pipeline gives ``COPY_PER_MILLE``,
as it drops near copies later; two texts sharing that much have a Jaccard similarity of
0.8), a text of which so much is lines that recur word for word is a near copy and counts
as its least such line, so that any number of edited copies counts as few; a page of one
short line of its own under a long menu looks the same. A line of more than ``max_tokens``
tokens has its leading tokens and the rest in blocks of equal length as tokens, so a
changed word spoils one block. A document of nothing but recurring lines loses them all.

Lines split at \\n, tokens at white space; blank lines stay. Null and empty
texts are unchanged. Repeated rows are treated alike; ties cannot arise, as all
decisions are by counts. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import balanced_join
from .common import SPACE_CHARS, Tables, free_names, join_by_key, keyed, table, words

# a word with a digit
FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
SIMILAR_PER_MILLE = 500
COPY_PER_MILLE = 889
SHARES_PER_MILLE = (0, 10, 100, 500)
MAJORITY_PER_MILLE = 800


def _lines(docs: DataFrame, depth: int, max_tokens: int) -> DataFrame:
    """``(_d, _k, cls, total, at, raw, chars, tokens, leaf, t0)``: all lines with words."""
    texts = keyed(
        docs.where("text IS NOT NULL"),
        F.xxhash64("text").alias("cls"),
        F.length("text").alias("total"),
        F.split("text", "\n").alias("l"),
    )
    lines = texts.select("_d", "_k", "cls", "total", F.posexplode("l").alias("at", "line"))
    lines = lines.where(F.btrim("line", F.lit(SPACE_CHARS)) != "")
    # one pass of a pattern over the line is faster than a test of each of its words
    masked = F.regexp_replace("line", FIELD, "<*>")
    masked = F.when(F.col("line").rlike("[0-9]"), masked).otherwise(F.col("line"))
    lines = lines.select(
        "_d", "_k", "cls", "total", "at", F.xxhash64("line").alias("raw"),
        F.length("line").alias("chars"), words(masked).alias("w"),
    )
    blocks, rest = max_tokens - depth, f"(size(w) - {depth})"
    hashed = (
        f"concat(slice(w, 1, {depth}), transform(sequence(0, {blocks - 1}), b -> CAST(xxhash64(slice("
        f"w, CAST({depth} + 1 + {rest} * b DIV {blocks} AS INT), "
        f"CAST({rest} * (b + 1) DIV {blocks} - {rest} * b DIV {blocks} AS INT))) AS STRING)))"
    )
    tokens = F.expr(f"IF(size(w) <= {max_tokens}, w, {hashed})")
    return lines.select(
        "_d", "_k", "cls", "total", "at", "raw", "chars", tokens.alias("tokens"),
        F.expr(f"xxhash64(size(w), slice(w, 1, {depth}))").alias("leaf"),
    ).withColumn("t0", F.xxhash64("tokens", "leaf"))


def templates(lines: DataFrame, min_docs: int, depth: int, tables: Tables) -> DataFrame:
    """``(t0, gs)``: the templates of every line text in a frequent leaf, one or more each."""
    texts = lines.groupBy("leaf", "t0").agg(
        F.first("tokens").alias("tokens"), F.count("*").alias("n")
    )
    texts = tables.store(texts.withColumn("n", F.col("n").cast("double")), "texts")
    exploded = texts.select("leaf", "t0", "n", F.posexplode("tokens").alias("p", "tok"))
    support = exploded.where(f"p >= {depth}").groupBy("leaf", "p", "tok").agg(F.sum("n").alias("s"))
    support = support.where(f"s >= {min_docs}")
    sizes = tables.store(texts.groupBy("leaf").agg(F.sum("n").alias("of")), "sizes")
    # all lines of a leaf are equally long: its lines are the lines of each place
    support = balanced_join(support, sizes, ["leaf"], sizes.count())
    support = support.select("leaf", "p", "tok", F.expr("1000 * s / of").alias("share"))
    support = tables.store(support, "constants")
    marked = balanced_join(exploded, support, ["leaf", "p", "tok"], support.count(), "left")
    share = F.when(F.col("p") < depth, 1000.0).otherwise(F.coalesce("share", F.lit(-1.0)))
    built = marked.groupBy("t0").agg(
        F.first("leaf").alias("leaf"),
        F.array_sort(F.collect_list(F.struct("p", "tok", share.alias("share")))).alias("x")
    )
    chosen = [
        f"IF(1000 * size(filter(x, y -> y.share >= {least} OR y.tok = '<*>')) "
        f">= {SIMILAR_PER_MILLE} * size(x), "
        f"xxhash64(transform(x, y -> IF(y.share >= {least}, y.tok, '<*>'))), xxhash64(x.tok))"
        for least in SHARES_PER_MILLE
    ]
    chosen.append(
        f"IF(1000 * size(filter(x, y -> y.share > 500)) >= {MAJORITY_PER_MILLE} * size(x), "
        "xxhash64('majority', leaf), xxhash64(x.tok))"
    )
    return built.select("t0", F.expr(f"array_distinct(array({', '.join(chosen)}))").alias("gs"))


def _common(pairs: DataFrame, min_docs: int) -> DataFrame:
    """``(g)`` of distinct ``(g, cls)``: the templates that ``min_docs`` or more texts have."""
    return pairs.groupBy("g").agg(F.count("*").alias("n")).where(f"n >= {min_docs}").select("g")


def recurring_lines(
    docs: DataFrame,
    tables: Tables,
    min_docs: int = 10,
    depth: int = 3,
    max_tokens: int = 24,
    copy_per_mille: int | None = None,
) -> DataFrame:
    """``(_d, _k, drop)``: positions of the recurring lines of each document that has some.

    ``copy_per_mille``: see above; None counts all distinct texts.
    """
    lines = tables.store(_lines(docs, depth, max_tokens), "lines")
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(f"n >= {min_docs}")
    leaves = tables.store(leaves.select("leaf"), "leaves")
    busy = balanced_join(lines, leaves, ["leaf"], leaves.count(), "left_semi")
    busy = tables.store(busy, "busy")
    known = tables.store(templates(busy, min_docs, depth, tables), "templates")
    placed = balanced_join(busy.drop("tokens", "leaf"), known, ["t0"], known.count())
    placed = placed.select("*", F.explode("gs").alias("g")).drop("gs", "t0")
    placed = tables.store(placed, "placed")
    found = tables.store(_common(placed.select("g", "cls").distinct(), min_docs), "common")
    placed = balanced_join(placed, found, ["g"], found.count(), "left_semi")
    if copy_per_mille is not None:
        placed = tables.store(placed, "shared")
        often = _without_copies(placed, tables, min_docs, copy_per_mille)
        placed = balanced_join(placed, often, ["g"], often.count(), "left_semi")
    return placed.groupBy("_d", "_k").agg(F.array_sort(F.collect_set("at")).alias("drop"))


def _without_copies(
    placed: DataFrame, tables: Tables, min_docs: int, copy_per_mille: int
) -> DataFrame:
    """``(g)``: the templates that still recur once a near copy counts as its least line."""
    spots = placed.select("cls", "total", "at", "raw", "chars").distinct()
    same = _common(spots.selectExpr("raw AS g", "cls").distinct(), min_docs).selectExpr("g AS raw")
    same = tables.store(same, "same")
    spots = balanced_join(spots, same, ["raw"], same.count(), "left_semi")
    copies = spots.groupBy("cls").agg(
        F.sum(F.expr("chars + 1")).alias("same"), F.first("total").alias("total"),
        F.min("raw").alias("copy"),
    ).where(f"1000 * same >= {copy_per_mille} * (total + 1)").select("cls", "copy")
    copies = tables.store(copies, "copies")
    marked = placed.select("g", "cls").distinct()
    marked = balanced_join(marked, copies, ["cls"], copies.count(), "left")
    marked = marked.select("g", F.coalesce("copy", "cls").alias("cls")).distinct()
    return tables.store(_common(marked, min_docs), "recurring")


def dedup_lines(docs: DataFrame, tables: Tables, **rules) -> DataFrame:
    """``docs`` with ``text`` rid of recurring lines, then the counts ``_lines, _dropped``."""
    drops = tables.store(recurring_lines(docs, tables, **rules), "drops")
    joined, names = join_by_key(docs, drops, "left")
    (lines,) = free_names(joined, "_l")
    drop = f"`{names['drop']}`"
    split = joined.withColumn(lines, F.split("text", "\n"))
    left = f"filter(`{lines}`, (x, i) -> NOT array_contains({drop}, i))"
    text = F.expr(f"IF({drop} IS NULL, text, array_join({left}, '\\n'))")
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_dropped = F.expr(f"CAST(IF({drop} IS NULL, 0, size({drop})) AS bigint)")
    return split.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        n_lines.alias("_lines"), n_dropped.alias("_dropped"),
    )


def op7(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_lines(docs, Tables(spark))
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("_lines")).alias("n_lines"),
        F.col("_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def drop_lines(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: every document stays, without its recurring lines; edited copies of
    one text count as few, as the next stage drops them."""
    found = dedup_lines(docs, Tables(spark), copy_per_mille=COPY_PER_MILLE)
    # by place: docs may have columns of the counts' names
    counts = free_names(docs, "_lines", "_dropped")
    return found.toDF(*docs.columns, *counts).drop(*counts)
