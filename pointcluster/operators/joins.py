"""Equi-joins that stay balanced when one key holds a large share of the rows.

``small`` is broadcast when its counted rows are few. Otherwise the rows of
frequent keys are spread over salts and the matching rows of ``small`` are
repeated once per salt, so every task gets a bounded share of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
ROWS_PER_SALT = 1_000_000
# A key is hot above total / HOT_KEYS rows, so there are fewer than HOT_KEYS
# hot keys whatever the data: the salt table may be broadcast.
HOT_KEYS = 50_000


def balanced_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    small_rows: int,
    how: str = "inner",
    big_counts: DataFrame | None = None,
    broadcast_rows: int | None = None,
    rows_per_salt: int | None = None,
    salted: bool = True,
) -> DataFrame:
    """Join ``big`` with ``small``; ``how`` is inner, left, left_semi or left_anti.

    ``small_rows`` is a counted upper bound of the rows of ``small``. The salt
    of a row is a hash of the whole row, so a recomputed task repeats it.
    ``salted=False`` is for keys that are known to have few rows each.
    ``big_counts`` may give the rows of ``big`` per key as ``(*on, n)``.
    """
    on = list(on)
    if small_rows <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return big.join(F.broadcast(small), on, how)
    salts = salt_table(big, on, big_counts, rows_per_salt) if salted else None
    if salts is None:
        return big.join(small, on, how)
    salts = F.broadcast(salts)
    spread = big.join(salts, on, "left").withColumn(
        "_salt",
        F.when(F.col("_salts").isNull(), F.lit(0))
        .otherwise(F.expr(f"pmod(xxhash64({', '.join(big.columns)}), _salts)"))
        .cast("int"),
    )
    repeated = small.join(salts, on, "left").withColumn(
        "_salt", F.explode(F.expr("sequence(0, coalesce(_salts, 1) - 1)"))
    )
    joined = spread.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how)
    return joined.drop("_salt")


def salt_table(
    big: DataFrame,
    on: Sequence[str],
    big_counts: DataFrame | None = None,
    rows_per_salt: int | None = None,
) -> DataFrame | None:
    """``(*on, _salts)`` for the hot keys of ``big``; None when there are none."""
    per_salt = ROWS_PER_SALT if rows_per_salt is None else rows_per_salt
    counts = big_counts
    if counts is None:
        counts = big.groupBy(*on).agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    if top["most"] is None or top["most"] <= per_salt:
        return None
    threshold = max(per_salt, -(-int(top["total"]) // HOT_KEYS))
    return counts.where(F.col("n") > threshold).select(
        *on, F.ceil(F.col("n") / F.lit(threshold)).cast("int").alias("_salts")
    )
