"""Places of rows on a space-filling curve whose cells hold about equal numbers of rows.

Every column is cut at quantiles (a mergeable sketch, one pass), so crowded regions get
small cells; the bits of the slices are interleaved. All of it is SQL: the cuts enter as
literals, and a row finds its slice by halving.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quantile_cuts(df: DataFrame, names: Sequence[str], bits: int) -> tuple[int, list[list[float]]]:
    """Number of rows, and ``2 ** bits - 1`` cuts per column; nulls are left out of the
    cuts, NaN is the largest value, and a column without values has cuts at 0. A cut is off
    by at most half a slice's rows."""
    side = 2**bits
    shares = [i / side for i in range(1, side)]
    found = [
        F.percentile_approx(F.col(f"`{n}`").cast("double"), shares, 2 * side).alias(f"c{i}")
        for i, n in enumerate(names)
        if shares
    ]
    row = df.agg(F.count("*").alias("rows"), *found).first()
    return row["rows"], [
        list(row[f"c{i}"] or [0.0] * len(shares)) if shares else [] for i in range(len(names))
    ]


def _number(value: float) -> str:
    return f"({value!r}D)" if math.isfinite(value) else f"double('{value}')"


def slice_sql(name: str, cuts: Sequence[float]) -> str:
    """How many of the sorted ``cuts`` (one less than a power of two) lie below the value:
    0 for null, all of them for NaN."""
    if not cuts:
        return "0L"
    bits = len(cuts).bit_length()
    steps = ", ".join(str(2**b) for b in reversed(range(bits)))
    at = f"element_at(array({', '.join(map(_number, cuts))}), p + s)"
    value = f"CAST(`{name}` AS DOUBLE)"
    return f"CAST(aggregate(array({steps}), 0, (p, s) -> IF({at} < {value}, p + s, p)) AS BIGINT)"


def interleaved_sql(slices: Sequence[str], bits: int) -> str:
    """Bit b of the i-th of d numbers becomes bit ``b * d + i``."""
    d = len(slices)
    parts = [
        f"shiftleft(shiftright({s}, {b}) & 1L, {b * d + i})"
        for i, s in enumerate(slices)
        for b in range(bits)
    ]
    return " | ".join(parts) or "0L"


def with_place(df: DataFrame, names: Sequence[str], cuts: Sequence[Sequence[float]], out: str) -> DataFrame:
    """``out`` (bigint): the row's place on the curve. Slices are columns of their own for
    a moment, so that each is looked up once."""
    bits = len(cuts[0]).bit_length()
    taken = {c.lower() for c in df.columns}
    slices = []
    for i in range(len(names)):
        name = f"_slice{i}"
        while name in taken:
            name += "_"
        taken.add(name)
        slices.append(name)
    cut = df.selectExpr("*", *[f"{slice_sql(n, c)} AS {s}" for n, c, s in zip(names, cuts, slices)])
    return cut.withColumn(out, F.expr(interleaved_sql(slices, bits))).drop(*slices)


def slices_of(place: int, d: int, bits: int) -> list[int]:
    """The numbers that were interleaved."""
    return [sum((place >> (b * d + i) & 1) << b for b in range(bits)) for i in range(d)]
