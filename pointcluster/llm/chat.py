"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context and only its reply is trainable. The turns after the last assistant
turn, if any, form one more example without a target, so the output holds the
whole conversation and can be read back.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a
backslash is doubled and every control string gets one after its first
character, so no text can imitate a mark; ``unescape`` undoes it. Escaping in a
role also covers its line ends.

Turns are ordered by (turn, role, text), so ties and repeated rows have a fixed
place. Null text or role: empty. Null conv_id: a conversation of its own. An
empty table gives no example. A conversation is the unit of context, hence one
row; its examples are exploded, so only one context is built at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

START, END = "<|im_start|>", "<|im_end|>\n"
# control strings of this and of other common templates (fixed values)
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column, control=CONTROL) -> Column:
    starts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in control)
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"({starts})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, control=CONTROL) -> DataFrame:
    """``turns (conv_id, turn, role, text)`` -> one row per example:

    ``conv_id, example, has_target, formatted, loss_start, loss_end`` with the
    mask as a range of code points of ``formatted`` (empty without a target).
    """
    role = F.regexp_replace(escape(F.col("role"), control), "\n", "\\\\\n")
    pieces = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
            escape(F.col("text"), control).alias("body"),
        ).alias("t"),
    )
    convs = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    convs = convs.select(
        "conv_id",
        "t",
        F.expr(f"transform(t, x -> concat(x.head, x.body, '{END[:-1]}\\n'))").alias("whole"),
    )
    # an example ends at each assistant turn, and at the last turn of all
    examples = convs.select(
        "conv_id", "t", "whole",
        F.expr(
            "explode(filter(sequence(1, size(t)), i -> t[i - 1].role = 'assistant' "
            "OR i = size(t))) AS at"
        ),
    )
    built = examples.select(
        "conv_id",
        F.col("at").alias("example"),
        F.expr("t[at - 1].role = 'assistant'").alias("has_target"),
        F.expr("array_join(slice(whole, 1, at - 1), '')").alias("context"),
        F.expr("t[at - 1].head").alias("head"),
        F.expr("t[at - 1].body").alias("body"),
    )
    start = F.length("context") + F.length("head")
    return built.select(
        "conv_id", "example", "has_target",
        F.concat("context", "head", "body", F.lit(END)).alias("formatted"),
        F.when(F.col("has_target"), start).otherwise(0).cast("long").alias("loss_start"),
        F.when(F.col("has_target"), start + F.length("body")).otherwise(0).cast("long")
        .alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of an example as array<struct<role, text>>, unescaped."""
    parts = F.filter(F.split(formatted, re.escape(END)), lambda x: x != "")
    head = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n"
    return F.transform(
        parts,
        lambda x: F.struct(
            unescape(F.regexp_extract(x, head, 1)).alias("role"),
            unescape(F.regexp_replace(x, head, "")).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation, taken from the formatted examples alone."""
    loss = unescape(
        F.expr("substring(formatted, CAST(loss_start AS int) + 1, CAST(loss_end - loss_start AS int))")
    )
    longest = F.max_by("formatted", "example")
    per = examples.select("conv_id", "example", "has_target", "formatted", loss.alias("loss"))
    per = per.groupBy("conv_id").agg(
        longest.alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("has_target"), F.struct("example", "loss"))))
        .alias("losses"),
        F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
    )
    per = per.select(
        "conv_id", "formatted_chars",
        read_turns(F.col("formatted")).alias("turns"),
        F.expr("array_join(transform(losses, x -> x.loss), '')").alias("loss"),
    )
    return per.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.expr("array_join(transform(turns, x -> concat(x.role, '\\n', x.text, '\\n')), '')"),
            256,
        ).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


PROBE = "</s>[INST] ok [/INST]"


def with_probe(turns: DataFrame) -> DataFrame:
    turns = turns.select("conv_id", "turn", "role", "text")
    probe = turns.sparkSession.sql(
        "SELECT CAST(-1 AS bigint) AS conv_id, CAST(turn AS bigint) AS turn, role, "
        f"'{PROBE}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)"
    )
    return turns.unionByName(probe)


def op2(spark, sf_dir) -> DataFrame:
    return read_back(format_chats(with_probe(table(spark, sf_dir, "conversations"))))


_ESC = """regexp_replace(replace(coalesce({0}, ''), '\\', '\\\\'),
    '(<s>|</s>|\\[INST\\]|\\[/INST\\]|<\\|im_start\\|>|<\\|im_end\\|>|<<SYS>>|<</SYS>>)',
    'X\\1', 'g')"""
OP2_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
n AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    length('{START}') + length({_ESC.format('role')}) + 1 + length({_ESC.format('text')})
      + length('{END[:-1]}') + 1 AS chars
    FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
u AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
"""
