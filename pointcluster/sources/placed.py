"""Tables laid out by place, so that a box filter reads what lies near the box.

Rows are range-partitioned and sorted along a space-filling curve over the named columns,
whose cells are cut at quantiles (``functions.curve``). The leading bits of the curve name
folders; inside them, rows of a row group are neighbours. A box then skips in two steps:
files of folders whose cells miss it are not opened, and of the files left, row groups and
pages whose bounds miss it are not read.

The cuts and the schema lie beside the rows in ``_layout``. At most 4,096 folders exist
and as many places are tried by the driver, whatever the table. Rows of one place (a third
of a table may share a point) are spread by a hash of the row over as many tasks as their
number needs.

Null coordinates lie in the first slice and fail every box; NaN lies in the last. Repeated
rows are stored as often as they come, an empty frame as an empty table with its schema.
Other columns keep their names; the folder's name gives way where it clashes.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.curve import quantile_cuts, slices_of, with_place
from ..functions.durable import replace
from ..functions.exprs import dimension, feature_names, features_column, lit, unpack

SLICE_BITS = 10
FOLDER_BITS = 12
ROWS_PER_FOLDER = 4_000_000
ROWS_PER_GROUP = 100_000


def write_placed(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    rows_per_folder: int = ROWS_PER_FOLDER,
    rows_per_group: int = ROWS_PER_GROUP,
) -> None:
    """Replace the table at ``path`` by ``df`` in the order of its places.

    ``columns`` are one to 60 numeric columns. Three passes over ``df``: the cuts,
    the bounds of the ranges, and the sorted write with its one shuffle.
    """
    if not columns or len(columns) > 60:
        raise ValueError("name one to 60 columns to place rows by")
    d = len(columns)
    bits = min(SLICE_BITS, 60 // d)
    rows, cuts = quantile_cuts(df, columns, bits)
    parts = max(1, math.ceil(rows / rows_per_folder))
    folder_bits = min(FOLDER_BITS, bits * d, (parts - 1).bit_length())
    folder, place = _free(df, "_folder"), _free(df, "_place")
    hashed = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    placed = with_place(df, columns, cuts, place).withColumn(
        folder, F.expr(f"CAST(shiftright(`{place}`, {bits * d - folder_bits}) AS INT)")
    )
    ordered = placed.repartitionByRange(parts, place, F.xxhash64(*hashed))
    ordered = ordered.sortWithinPartitions(folder, place).drop(place)
    layout = {
        "columns": list(columns), "cuts": cuts, "bits": bits, "folder": folder,
        "folder_bits": folder_bits, "schema": json.loads(df.schema.json()),
    }

    def write(staged: str) -> None:
        writer = ordered.write.option("parquet.block.row.count.limit", rows_per_group)
        writer.partitionBy(folder).parquet(staged)
        spark = df.sparkSession
        spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.text(
            f"{staged}/_layout"
        )

    replace(df.sparkSession, path, write)


def read_placed(
    spark: SparkSession, path: str, box: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """The rows of ``write_placed``, those strictly inside ``box`` if it is given.

    ``box`` may name any numeric columns; those the rows are placed by decide what is read.
    """
    layout = json.loads(spark.read.text(f"{path}/_layout").first()["value"])
    schema = T.StructType.fromJson(layout["schema"])
    folder = layout["folder"]
    stored = T.StructType([*schema.fields, T.StructField(folder, T.IntegerType())])
    rows = spark.read.schema(stored).option("basePath", path).parquet(path)
    if box:
        rows = rows.where(F.col(folder).isin(_folders(layout, box)))
        rows = rows.where(
            " AND ".join(f"`{c}` > {lit(lo)} AND `{c}` < {lit(hi)}" for c, (lo, hi) in box.items())
        )
    return rows.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema])


def write_placed_points(points: DataFrame, path: str, **options) -> None:
    """Points placed by their features, which are stored as columns ``f0..`` because
    bounds of array elements are not kept. A null or NaN feature is an error."""
    d = dimension(points)
    write_placed(unpack(points, d, "id"), path, feature_names(d), **options)


def read_placed_points(
    spark: SparkSession, path: str, box: Sequence[tuple[float, float]] | None = None
) -> DataFrame:
    """``(id, features)``; ``box`` holds a pair of exclusive bounds per feature."""
    named = dict(zip(feature_names(len(box)), box)) if box else None
    rows = read_placed(spark, path, named)
    return rows.select("id", features_column([c for c in rows.columns if c != "id"]))


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _folders(layout: dict, box: Mapping[str, tuple[float, float]]) -> list[int]:
    """Folders whose cells meet the box. A folder is a stretch of the curve and so a block
    of slices; slice s holds values above cut s - 1 and up to cut s."""
    d, bits = len(layout["columns"]), layout["bits"]
    rest = bits * d - layout["folder_bits"]
    met = []
    for folder in range(2 ** layout["folder_bits"]):
        first = slices_of(folder << rest, d, bits)
        last = slices_of(((folder + 1) << rest) - 1, d, bits)
        for name, cuts, low, high in zip(layout["columns"], layout["cuts"], first, last):
            lo, hi = box.get(name, (-math.inf, math.inf))
            below = low > 0 and not cuts[low - 1] < hi
            above = high < len(cuts) and not cuts[high] > lo
            if name in box and (below or above):
                break
        else:
            met.append(folder)
    return met
