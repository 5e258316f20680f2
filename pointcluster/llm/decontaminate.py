"""Benchmark decontamination as a prefix-filtered set join.

A window is ``window`` consecutive words of an item (a shorter item is one
window). Its shingles are runs of ``shingle`` words; a window occurs only where
all of them do, so one necessary prefix token is enough: the shingle that is
rarest among the documents. Documents are joined on those rare tokens alone,
positional and length bounds drop places where the window cannot lie, and the
words themselves confirm containment.

1. one pass over all texts notes which item shingles each document holds, as hashes;
2. item shingles are ordered by rarity: how often they occur in all documents, then in the
   items themselves. Each distinct window keeps its rarest one (first offset on ties);
3. documents that hold one of these prefix tokens are probed for them alone; their places
   are the candidates, and the words around them confirm or refute the window.

Texts never shuffle: the benchmark's shingles, and then the keys of the documents to probe,
are broadcast, in as many blocks of ``BROADCAST_BYTES`` as their counted size asks for, a
pass each.

Null, empty and wordless texts: no words, no hits. Items without words take no
part. Repeated documents or items are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import balanced_join
from .common import (
    NO_ID,
    NON_WORD,
    NON_WORD_CHARS,
    Tables,
    ascii_lower,
    join_by_key,
    key_columns,
    table,
    words,
)

BROADCAST_BYTES = 32 << 20
EMPTY_SHA = "sha2('', 256)"


def item_words(text: Column) -> Column:
    return words(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD, NON_WORD_CHARS)


def _shingles(sizes: list[int], arr: str) -> str:
    """SQL: array of (h, p): hash and position of every shingle of the words hashed in ``arr``."""
    none = "CAST(array() AS array<struct<h:bigint,p:int>>)"
    one = [
        f"IF(size({arr}) < {s}, {none}, transform(sequence(0, size({arr}) - {s}), p -> "
        f"named_struct('h', xxhash64({s}, {', '.join(f'{arr}[p + {j}]' for j in range(s))}), "
        f"'p', p)))"
        for s in sizes
    ]
    return one[0] if len(one) == 1 else f"concat({', '.join(one)})"


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``(words, len, items)``: each distinct window with the items it is in."""
    w = items.select(
        F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("w")
    ).where("size(w) > 0")
    w = w.select(
        "item",
        F.expr(
            f"explode(transform(sequence(0, greatest(size(w) - {window}, 0)), "
            f"p -> slice(w, p + 1, {window}))) AS words"
        ),
    )
    return w.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _tokens(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``(words, len, items, h, at)``: the shingles of every window."""
    hashed = windows.withColumn("wh", F.expr("transform(words, x -> xxhash64(x))"))
    parts = [
        hashed.where(f"s = {s}").select(
            "words", "len", "items", F.expr(f"explode({_shingles([s], 'wh')}) AS x")
        )
        for s in sizes
    ]
    tokens = parts[0]
    for part in parts[1:]:
        tokens = tokens.unionByName(part)
    return tokens.select("words", "len", "items", F.col("x.h").alias("h"), F.col("x.p").alias("at"))


def _places(
    docs: DataFrame, wanted: DataFrame, sizes: list[int], window: int | None
) -> DataFrame:
    """``(_d, _k, n, h)``: the wanted shingles of every document, and a row without ``h``
    per document, for its number of words ``n``. With ``window`` these ``(_d, _k, n, h, p,
    around, shift)`` instead: where they are, with the words a window there can cover
    (``around[shift]`` is the shingle's first word), and no row without ``h``."""
    texts = docs.select(*key_columns(), item_words(F.col("text")).alias("w"))
    texts = texts.withColumn("wh", F.expr("transform(w, x -> xxhash64(x))"))
    texts = texts.withColumn("n", F.size("w").cast("bigint"))
    blocks = _blocks(wanted.count())
    counted = "array(named_struct('h', CAST(NULL AS bigint), 'p', 0))"
    back = (window or 0) - min(sizes, default=1)
    # a row per shingle carries the words around it, never those of the whole text
    around = (
        "transform({}, x -> named_struct('h', x.h, 'p', x.p, 'around', "
        f"slice(w, greatest(x.p - {back}, 0) + 1, {back} + {window})))"
    )
    more = ["x.p AS p", "x.around AS around", f"least(x.p, {back}) AS shift"] if window else []
    out = None
    for block in range(blocks):
        mine = wanted.where(f"pmod(h, {blocks}) = {block}") if blocks > 1 else wanted
        listed = _shingles(sizes, "wh") if sizes else counted
        if block == 0 and window is None:
            listed = f"concat({counted}, {listed})" if sizes else counted
            mine = mine.unionByName(mine.sparkSession.sql("SELECT CAST(NULL AS bigint) AS h"))
        listed = around.format(listed) if window else listed
        grams = texts.select("_d", "_k", "n", F.expr(f"explode({listed}) AS x"))
        grams = grams.selectExpr("_d", "_k", "n", "x.h AS h", *more)
        mine = F.broadcast(mine.withColumnRenamed("h", "wanted"))  # a block's bytes are bounded
        found = grams.join(mine, F.col("h").eqNullSafe(F.col("wanted")), "left_semi")
        out = found if out is None else out.unionByName(found)
    return out


def _blocks(rows: int) -> int:
    return max(1, -(-16 * rows // max(BROADCAST_BYTES, 1)))


def _holding(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``_k`` is among the distinct ``keys (_k)``."""
    docs, blocks, out = docs.select("doc_id", "text"), _blocks(keys.count()), None
    for block in range(blocks):
        mine = keys.where(f"pmod(_k, {blocks}) = {block}") if blocks > 1 else keys
        on = key_columns()[1] == F.col("_k")
        found = docs.join(F.broadcast(mine), on, "left_semi")  # a block's bytes are bounded
        out = found if out is None else out.unionByName(found)
    return out


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    tables: Tables,
    window: int = 10,
    shingle: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """``(_d, _k, start, len, items)``: every occurrence of an item window; and
    ``(_d, _k, n)``: the number of words of every document."""
    windows = item_windows(items, window).select(
        "*", F.size("words").alias("len"), F.expr(f"least(size(words), {shingle})").alias("s")
    )
    windows = tables.store(windows, "windows")
    sizes = sorted(r["s"] for r in windows.select("s").distinct().collect())  # at most `shingle`
    tokens = tables.store(_tokens(windows, sizes or [1]), "tokens")
    own = tokens.groupBy("h").agg(F.count("*").alias("own"))
    own = tables.store(own, "wanted")
    held = tables.store(_places(docs, own.select("h"), sizes, None), "held")
    some = held.where("h IS NOT NULL")
    seen = tables.store(some.groupBy("h").agg(F.count("*").alias("n")), "rarity")
    order = F.struct(F.coalesce("n", F.lit(0)), "own", "at")
    rarest = (
        tokens.join(own, "h").join(seen, "h", "left")
        .groupBy("words", "len", "items")
        .agg(F.min_by(F.struct("h", "at"), order).alias("t"))
        .select("words", "len", "items", F.col("t.h").alias("h"), F.col("t.at").alias("at"))
    )
    rarest = tables.store(rarest, "prefix")
    prefix = tables.store(rarest.select("h").distinct(), "tokens")
    probed = balanced_join(some, prefix, ["h"], prefix.count(), "left_semi")
    probed = tables.store(probed.select("_k").distinct(), "probed")
    places = tables.store(_places(_holding(docs, probed), prefix, sizes, window), "places")
    found = balanced_join(
        places, rarest, ["h"], rarest.count(), broadcast_rows=50_000
    ).where(
        "p >= at AND p - at + len <= n AND slice(around, shift - at + 1, len) = words"
    )
    hits = found.selectExpr("_d", "_k", "p - at AS start", "len", "items")
    return hits, held.where("h IS NULL").select("_d", "_k", "n")


def decontaminate(
    docs: DataFrame, items: DataFrame, tables: Tables, window: int = 10, shingle: int = 5
) -> DataFrame:
    """One row per document row: ``_d, _k, n, n_hit, hits, item_ids`` (null without a hit)."""
    hits, sizes = find_hits(docs, items, tables, window, shingle)
    spans = hits.groupBy("_d", "_k").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))))
        .alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    covered = F.expr(
        "aggregate(hits, named_struct('n', 0L, 'to', 0), (a, x) -> named_struct("
        "'n', a.n + greatest(x.end - greatest(x.start, a.to), 0), 'to', greatest(a.to, x.end)), "
        "a -> a.n)"
    )
    spans = spans.select("_d", "_k", covered.alias("n_hit"), "hits", "item_ids")
    return sizes.join(spans, ["_d", "_k"], "left")


def op3(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), Tables(spark)).selectExpr(
        f"IF(_d = {NO_ID}, NULL, _d) AS doc_id",
        "n AS n_words",
        "coalesce(n_hit, 0L) AS n_hit",
        "CAST(coalesce(size(item_ids), 0) AS bigint) AS n_items",
        f"coalesce(sha2(array_join(item_ids, ','), 256), {EMPTY_SHA}) AS items_sha256",
        "coalesce(n_hit, 0L) > 0 AS contaminated",
    )


def drop_contaminated(spark, docs, sf_dir) -> DataFrame:
    """Pipeline stage: documents holding a benchmark window go, all others stay."""
    hits, _ = find_hits(docs, table(spark, sf_dir, "benchmark"), tables := Tables(spark))
    hits = tables.store(hits.select("_d", "_k").distinct(), "hits")
    rows, _ = join_by_key(docs, hits, "left_anti")
    return rows


_W = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_W} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_W} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, array_to_string(w[p:p + 9], ' ') AS g, least(len(w), 10) AS n
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
    FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT r, p, dw.n, item FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (
    SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hit)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
    FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
