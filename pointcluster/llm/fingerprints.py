"""Document fingerprints: SimHash votes, and a radius search over permuted block tables.

The terms of a text are its distinct pairs of neighbouring words in lower case (a
single word stands alone), each with its length, at most 15, as weight: long pairs are
rare ones. Every term's hash votes on 128 signed bits. Votes are summed as packed
counters, two to a long, in one aggregate inside the task that holds the text.

``within_radius`` finds all fingerprints at a Hamming distance of at most ``radius``.
The bits are cut into ``radius + lead`` blocks, and there is a table for every choice of
``lead`` of them: two fingerprints within the radius agree on all blocks of at least one
table, so each table is an equi-join on its leading blocks. Equal fingerprints meet as
one row with a count, members of a crowded key are spread over chunks of their own, and
a pair counts in the first table that brings it together.

Null text: empty. No words: no votes, all bits 0. A tied vote is 0. Null ids come last
in the descending order of documents, rows with one id follow their text's hash, and
repeated rows follow each other, each with a result of its own. The last document's
next is the first, so a single document is its own next. Empty tables give no rows.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, Tables, table, words

BITS = 128
RADIUS = 3
CHUNK = 256
RANGE_CHARS = 32 << 20
SAMPLED_KEYS = 64  # for each range
PACKED = 2**32 + 1


def terms(w: str) -> Column:
    """Distinct term hashes of the word array in column ``w``; the last four bits of a
    hash are its term's weight."""
    term = "(xxhash64({0}) & -16L) | CAST(least(15, {1}) AS BIGINT)"
    pair = term.format(f"{w}[i], {w}[i + 1]", f"length({w}[i]) + length({w}[i + 1])")
    alone = term.format(f"{w}[0]", f"length({w}[0])")
    return F.expr(
        f"CASE WHEN size({w}) = 0 THEN CAST(array() AS array<bigint>) "
        f"WHEN size({w}) = 1 THEN array({alone}) ELSE "
        f"array_distinct(transform(sequence(0, size({w}) - 2), i -> {pair})) END"
    )


def simhash(rows: DataFrame, keys: list[str], terms: str = "terms") -> DataFrame:
    """``(*keys, f0, f1)``: the 128 bits of each row; ``keys`` tell rows apart.

    Where ``rows`` are already partitioned by one of ``keys`` nothing is shuffled.
    """
    each = rows.select(*keys, F.explode_outer(terms).alias("_h")).selectExpr(
        *keys, "_h & 15 AS _w", "xxhash64(_h, 0) AS _h0", "xxhash64(_h, 1) AS _h1"
    )
    sums = [
        F.expr(f"sum((shiftright(_h{k}, {b}) & {PACKED}L) * _w)").alias(f"_v{k}_{b}")
        for k in (0, 1)
        for b in range(32)
    ]
    voted = each.groupBy(*keys).agg(F.sum("_w").alias("_all"), *sums)

    def half(k: int, part: str) -> str:
        on = "IF(2 * {0} > _all, {1}L, 0L)"
        return " | ".join(on.format(part.format(f"_v{k}_{b}"), 1 << b) for b in range(32))

    low, high = "({0} & 4294967295L)", "shiftrightunsigned({0}, 32)"
    return voted.selectExpr(
        *keys, *[f"({half(k, low)}) | shiftleft({half(k, high)}, 32) AS f{k}" for k in (0, 1)]
    )


def hex_bits(a: str, b: str) -> Column:
    return F.expr(f"lower(concat(lpad(hex({a}), 16, '0'), lpad(hex({b}), 16, '0')))")


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits; 1 for equal fingerprints."""
    apart = " + ".join(f"bit_count({x} ^ {y})" for x, y in zip(a, b))
    return F.expr(f"({BITS} - ({apart})) / {BITS}D")


# -- neighbours in the order of documents --------------------------------------


def _cuts(slim: DataFrame, rows: int, parts: int) -> list[tuple[int, int]]:
    """Keys that cut the descending order into about ``parts`` equal ranges; they only
    deal out work. At most about ``SAMPLED_KEYS * parts`` keys reach the driver."""
    step = max(1, rows // (SAMPLED_KEYS * parts))
    chosen = slim.where(F.pmod(F.xxhash64("_d", "_k", F.lit(step)), F.lit(step)) == 0)
    keys = sorted({tuple(r) for r in chosen.distinct().collect()}, reverse=True)
    if len(keys) <= parts:
        return keys[1:]
    return [keys[i * len(keys) // parts] for i in range(1, parts)]


def in_ranges(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """``(p, halo, _d, _k, doc_id, text)``: rows dealt to ranges of the descending order.

    The first row of every range also stands, as halo, at the end of the range before
    it (the very first at the end of the last), so that every row finds its next one
    in its own range.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"),
        F.xxhash64("text").alias("_k"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    found = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.length("text")).alias("chars"),
        F.max(F.struct("_d", "_k")).alias("top"),
    ).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-(found["chars"] or 0) // range_chars))
    cuts = sorted(set(_cuts(rows.select("_d", "_k"), found["n"], parts)), reverse=True)
    group = max(1, int(len(cuts) ** 0.5))
    groups = [
        [{"d": d, "k": k} for d, k in cuts[i : i + group]] for i in range(0, len(cuts), group)
    ]
    top = found["top"] or (0, 0)
    kind = "array<struct<d:bigint,k:bigint>>"
    placed = rows.select(
        "*",
        F.from_json(F.lit(json.dumps({"g": groups})), f"g array<{kind}>")["g"].alias("_cuts"),
        F.expr("named_struct('d', _d, 'k', _k)").alias("_key"),
    )
    placed = placed.withColumn("_t", F.expr("size(filter(_cuts, g -> _key <= g[0]))"))
    placed = placed.withColumn(
        "p",
        F.expr(
            f"IF(_t = 0, 0, (_t - 1) * {group} + size(filter(_cuts[_t - 1], b -> _key <= b)))"
        ),
    )
    # a row that is a cut begins its range; the top row begins the first one
    before = (
        f"CASE WHEN _d = {top[0]}L AND _k = {top[1]}L THEN {len(cuts)} "
        "WHEN p > 0 AND array_contains(_cuts[_t - 1], _key) THEN p - 1 END"
    ).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    placed = placed.withColumn("_before", F.expr(before))
    return placed.select(
        F.explode(
            F.expr(
                "IF(_before IS NULL, array(named_struct('p', p, 'halo', false)), array("
                "named_struct('p', p, 'halo', false), named_struct('p', _before, 'halo', true)))"
            )
        ).alias("_at"),
        "_d", "_k", "doc_id", "text",
    ).select("_at.p", "_at.halo", "_d", "_k", "doc_id", "text")


def edited_prints(docs: DataFrame, range_chars: int = RANGE_CHARS) -> DataFrame:
    """Per document its fingerprint ``f0, f1``, that of its edited text ``e0, e1`` and its
    next one's ``x0, x1``, with ``doc_id, n_chars, edited_sha256``.

    The edited text has the last third of the code points replaced by the first ones
    of the next document. Texts are shuffled once, to their ranges; all later steps
    group and order within a range.
    """
    order = Window.partitionBy("p").orderBy("halo", F.desc("_d"), F.desc("_k"))
    following = in_ranges(docs, range_chars).select(
        "p", "halo", "doc_id", "text",
        F.row_number().over(order).alias("at"),
        F.lead("text").over(order).alias("_next"),
    )
    edited = following.select(
        "p", "halo", "at", "doc_id", "text",
        F.length("text").cast("long").alias("n_chars"),
        F.when(
            ~F.col("halo"),
            F.expr(
                "concat(left(text, length(text) - length(text) DIV 3), "
                "left(_next, CAST(length(text) DIV 3 AS INT)))"
            ),
        ).alias("_edited"),
    )
    split = edited.select(
        "p", "halo", "at", "doc_id", "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        words(F.lower("text")).alias("_w"),
        words(F.lower("_edited")).alias("_we"),
    )
    sides = split.select(
        "p", "halo", "at", "doc_id", "n_chars", "edited_sha256",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), terms("_w").alias("terms")),
                F.struct(F.lit(1).alias("side"), terms("_we").alias("terms")),
            )
        ).alias("_s"),
    ).select("p", "at", "halo", "doc_id", "n_chars", "edited_sha256", "_s.side", "_s.terms")
    keys = ["p", "at", "halo", "doc_id", "n_chars", "edited_sha256"]
    prints = simhash(sides, [*keys, "side"])
    both = prints.groupBy(*keys).agg(
        *[F.max(F.expr(f"IF(side = {s}, f{k}, NULL)")).alias(f"{n}{k}")
          for s, n in ((0, "f"), (1, "e")) for k in (0, 1)]
    )
    order = Window.partitionBy("p").orderBy("at")
    return both.select(
        *both.columns, *[F.lead(f"f{k}").over(order).alias(f"x{k}") for k in (0, 1)]
    ).where("NOT halo").drop("p", "at", "halo")


# -- search ------------------------------------------------------------------


def block_tables(prints: DataFrame, radius: int, lead: int) -> DataFrame:
    """``prints (f0, f1, ...)`` once per table, with ``t`` and the leading blocks ``key``.

    Blocks are runs of hexadecimal digits.
    """
    digits, blocks = BITS // 4, radius + lead
    if blocks > digits:
        raise ValueError(f"radius + lead must be at most {digits}")
    ends = [i * digits // blocks for i in range(blocks + 1)]
    keys = [
        "concat(%s)" % ", ".join(
            f"substring(_x, {ends[b] + 1}, {ends[b + 1] - ends[b]})" for b in chosen
        )
        for chosen in combinations(range(blocks), lead)
    ]
    tables = ", ".join(f"named_struct('t', {t}, 'key', {k})" for t, k in enumerate(keys))
    return (
        prints.withColumn("_x", hex_bits("f0", "f1"))
        .select(*prints.columns, F.explode(F.expr(f"array({tables})")).alias("_t"))
        .select(*prints.columns, "_t.t", "_t.key")
    )


def within_radius(
    prints: DataFrame, queries: DataFrame, tables: Tables, radius: int = RADIUS, lead: int = 1
) -> DataFrame:
    """``(f0, f1, n_rows, n_prints)`` for each distinct fingerprint of ``queries``: the rows and
    the distinct fingerprints of ``prints`` within ``radius`` (itself included if there).

    A key with more than ``CHUNK`` fingerprints is cut into chunks by their hash, each
    an array of bounded size in a group of its own; its probes go to every chunk and
    count there, so pairs are never rows.
    """
    index = block_tables(
        prints.groupBy("f0", "f1").agg(F.count("*").alias("n")), radius, lead
    )
    index = tables.store(index, "blocks")
    probes = block_tables(
        queries.select(F.col("f0"), F.col("f1")).distinct(), radius, lead
    ).withColumnsRenamed({"f0": "q0", "f1": "q1"})
    sizes = index.groupBy("t", "key").agg(F.count("*").alias("m")).where(f"m > {CHUNK}")
    sizes = tables.store(
        sizes.select("t", "key", F.expr(f"CAST(ceil(m / {CHUNK}) AS INT)").alias("chunks")), "sizes"
    )
    chunked = (
        index.join(sizes, ["t", "key"], "left")
        .withColumn("chunk", F.expr("pmod(xxhash64(f0, f1), coalesce(chunks, 1))"))
        .groupBy("t", "key", "chunk")
        .agg(F.collect_list(F.struct("f0", "f1", "n")).alias("members"))
    )
    asked = probes.join(sizes, ["t", "key"], "left").select(
        "t", "key", "q0", "q1",
        F.explode(F.expr("sequence(0L, coalesce(chunks, 1) - 1L)")).alias("chunk"),
    )
    # blocks of the pair's difference that are zero tell the first table they share
    digits, blocks = BITS // 4, radius + lead
    ends = [i * digits // blocks for i in range(blocks + 1)]

    def mask(chosen, half: int) -> int:
        value = 0
        for b in chosen:
            for digit in range(ends[b], ends[b + 1]):
                if digit // 16 == half:
                    value |= 0xF << 4 * (15 - digit % 16)
        return value - 2**64 if value >= 2**63 else value

    zero = [
        f"((m.f0 ^ q0) & {mask(c, 0)}L) = 0 AND ((m.f1 ^ q1) & {mask(c, 1)}L) = 0"
        for c in combinations(range(blocks), lead)
    ]
    first = " ".join(f"WHEN t = {t} THEN NOT ({' OR '.join(zero[:t])})" for t in range(1, len(zero)))
    first = f"CASE {first} ELSE true END" if first else "true"
    near = (
        f"filter(members, m -> bit_count(m.f0 ^ q0) + bit_count(m.f1 ^ q1) <= {radius} AND {first})"
    ).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    met = asked.join(chunked, ["t", "key", "chunk"]).select("q0", "q1", F.expr(near).alias("near"))
    return met.groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1")).agg(
        F.sum(F.expr("aggregate(near, 0L, (a, m) -> a + m.n)")).alias("n_rows"),
        F.sum(F.size("near")).cast("long").alias("n_prints"),
    )


def fingerprinted(docs: DataFrame, tables: Tables, every: int = 50) -> DataFrame:
    """One row per document: both fingerprints, their likenesses, and for documents whose
    id is divisible by ``every`` the rows of the whole table within the radius."""
    prints = tables.store(edited_prints(docs), "prints")
    asked = prints.where(F.col("doc_id") % every == 0)
    near = tables.store(within_radius(prints, asked, tables), "near")
    out = [
        "doc_id", "n_chars", "edited_sha256",
        hex_bits("f0", "f1").alias("fingerprint"),
        hex_bits("e0", "e1").alias("edited_fingerprint"),
        likeness(("f0", "f1"), ("e0", "e1")).alias("near_edited"),
        likeness(("f0", "f1"), ("x0", "x1")).alias("near_next"),
    ]
    found = asked.join(near, ["f0", "f1"], "left").select(
        *out, F.col("n_rows").alias("n_within"), F.col("n_prints").alias("prints_within")
    )
    rest = prints.where((F.col("doc_id") % every != 0) | F.col("doc_id").isNull()).select(
        *out, F.lit(None).cast("long").alias("n_within"),
        F.lit(None).cast("long").alias("prints_within"),
    )
    return found.unionByName(rest)


def op13(spark, sf_dir) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"), Tables(spark))
