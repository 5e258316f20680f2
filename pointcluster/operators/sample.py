"""Ordered limits and seeded samples, exact and repeatable, also where keys repeat.

``orderBy(...).limit(n)`` sends up to n rows of every partition to one task.
That is right for a few rows. Larger n first looks up the n-th key and then
filters on it, so that no task sees more than its own partition and no key is
shuffled: one scan counts, the next counts below two keys that enclose the
wanted one, and the keys in between, few by then, are ordered. For a seeded
sample the two keys follow from the digests being uniform; for other keys from
a hash sample of them, in as many rounds as it takes to get to ``BAND_ROWS``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOP_ROWS = 100
BAND_ROWS = 100_000
SAMPLE_KEYS = 50_000
DIGEST_RANGE = 2**60


def raw_limit(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` raw rows by a key, before any filter; null keys come first."""
    if not order:
        raise ValueError("a limit without an order does not repeat: name a key")
    return first_rows(df, n, [F.col(c) for c in order])


def limit_points(points: DataFrame, n: int | None, top_rows: int = TOP_ROWS) -> DataFrame:
    """The first ``n`` points by id; None keeps all, n <= 0 is refused."""
    if n is None:
        return points
    return first_rows(points, n, [F.col("id")], top_rows)


def sample_order(seed: int | str, id_column: str = "id") -> list[Column]:
    """md5(seed:id), then the id; led by the digest's first 60 bits as a number,
    which sorts alike and can be counted in ranges without a shuffle."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    return [F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), digest, F.col(id_column)]


def seeded_sample(
    points: DataFrame, n: int, seed: int | str = 42, top_rows: int = TOP_ROWS
) -> DataFrame:
    """At most ``n`` points without replacement.

    Ordered by md5(seed:id): the same rows on any partitioning, and all rows
    when ``n`` reaches their number.
    """
    return first_rows(points, n, sample_order(seed), top_rows, uniform=True)


def first_rows(
    df: DataFrame, n: int, order: list[Column], top_rows: int = TOP_ROWS, uniform: bool = False
) -> DataFrame:
    """The ``n`` least rows; ``uniform``: the first key is a digest.

    Rows with equal keys follow a hash of the whole row (but for maps); rows that are the
    same throughout are interchangeable, and as many of them come as are missing. So there
    are exactly ``n`` rows, or all, whatever repeats.
    """
    if n <= 0:
        raise ValueError("limit must be a positive integer")
    hashed = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    order = [*order, F.xxhash64(*hashed)]
    if n <= top_rows:
        return df.orderBy(*order).limit(n)
    packed = df.select(F.struct("*").alias("_p"), *[c.alias(f"_k{i}") for i, c in enumerate(order)])
    keys = [f"_k{i}" for i in range(len(order))]
    found = _nth_key(packed.select(*keys), n, keys, uniform)
    if found is None:
        return df
    cut, wanted, there = found
    kept = packed.where(_up_to(packed, keys, cut))
    if wanted < there:
        last = kept.where(_same(packed, keys, cut)).limit(1)
        last = last.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(wanted)))).drop("_n")
        kept = kept.where(~_same(packed, keys, cut)).unionByName(last)
    return kept.select("_p.*")


def _typed(df: DataFrame, keys: list[str], values):
    names = keys[: len(values)]
    typed = [F.lit(v).cast(df.schema[k].dataType).alias(k) for v, k in zip(values, names)]
    return F.struct(*names), F.struct(*typed)


def _same(df: DataFrame, keys: list[str], values) -> Column:
    own, other = _typed(df, keys, values)
    return own.eqNullSafe(other)


def _up_to(df: DataFrame, keys: list[str], values) -> Column:
    """Keys not beyond ``values``, which may name the leading columns only."""
    own, other = _typed(df, keys, values)
    return own <= other


def _nth_key(keyed: DataFrame, n: int, keys: list[str], uniform: bool):
    """The n-th least key, how many rows with it are among the first n, and how many there
    are; None if there are no more than n rows."""
    rows = keyed.count()
    if rows <= n:
        return None
    band, left = keyed, n
    while rows > max(BAND_ROWS, SAMPLE_KEYS):
        low, high = _digests(left, rows) if uniform else _sampled(band, left, rows, keys)
        uniform = False  # what is left of a digest's range is sampled
        if not low and not high:
            break  # too few sampled keys to narrow: the band is small
        below = _up_to(keyed, keys, low) if low else F.lit(False)
        above = ~_up_to(keyed, keys, high) if high else F.lit(False)
        n_low, n_high = band.agg(F.count_if(below), F.count_if(above)).first()
        if n_low >= left:
            band, rows = band.where(below), n_low
        elif rows - n_high < left:
            band, left, rows = band.where(above), left - (rows - n_high), n_high
        else:
            band, left, rows = band.where(~below & ~above), left - n_low, rows - n_low - n_high
    # what is left has few rows (or few distinct keys), and one order for all of them
    counts = band.groupBy(*keys).agg(F.count("*").alias("_n")).orderBy(*keys).limit(left)
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy(*keys)))
    last = upto.where(F.col("_upto") >= left).orderBy("_upto").first()
    return [last[k] for k in keys], left - (last["_upto"] - last["_n"]), last["_n"]


def _digests(n: int, rows: int):
    """Bounds that enclose the n-th of ``rows`` uniform digests but for odds of one in 1e15."""
    slack = 8 * math.sqrt(n) + 8
    low, high = ((n + s) / rows * DIGEST_RANGE for s in (-slack, slack))
    return ([int(low)] if low > 0 else None), ([int(high)] if high < DIGEST_RANGE else None)


def _sampled(band: DataFrame, n: int, rows: int, keys: list[str]):
    """Sampled keys around the n-th; at most about ``SAMPLE_KEYS`` reach the driver."""
    part = min(1_000_000, int(SAMPLE_KEYS / rows * 1_000_000) + 1)
    chosen = band.where(F.pmod(F.xxhash64(*keys, F.lit(rows)), F.lit(1_000_000)) < part)
    sample = sorted(tuple(r) for r in chosen.collect())
    slack = 6 * math.sqrt(len(sample)) + 2
    low, high = (int(n / rows * len(sample) + s) for s in (-slack, slack))
    return (sample[low] if low >= 0 else None), (sample[high] if high < len(sample) else None)
