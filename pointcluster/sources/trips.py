"""Raw trip records: CSV with a header, explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
    ]
)


# Fixed value: keeps microseconds, which the default drops.
MICROS = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = TRIP_SCHEMA,
    infer_schema: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Read trips from CSV.

    Columns are matched to the header by name, so files may carry more columns
    in any order; only the selected ones are parsed. All files of a folder need
    the same header: one that differs is an error, never a swap of columns.
    ``infer_schema`` costs a further pass over the files.
    """
    if infer_schema:
        df = spark.read.csv(path, header=True, inferSchema=True, enforceSchema=False)
    else:
        header = spark.read.csv(path, header=True, enforceSchema=False).columns
        wanted = {f.name: f for f in schema.fields}
        missing = [n for n in (columns or wanted) if n not in header]
        if missing:
            raise ValueError(f"columns not in the CSV header: {missing}")
        full = T.StructType(
            [wanted.get(n, T.StructField(n, T.StringType())) for n in header]
        )
        df = spark.read.csv(path, header=True, schema=full, enforceSchema=False).select(
            *[n for n in wanted if n in header]
        )
    return df.select(*columns) if columns else df


def write_trips(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        timestampNTZFormat=MICROS, timestampFormat=MICROS
    ).csv(path, header=True)


def pruned(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; the projection is pushed into the scan."""
    return df.select(*columns)
