import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pointcluster-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_points(spark):
    """Rows of coordinates (or {id: coordinates}) -> points frame."""

    def build(rows, parts=3):
        items = rows.items() if isinstance(rows, dict) else enumerate(rows)
        data = [(i, [float(v) for v in x]) for i, x in items]
        kind = "string" if data and isinstance(data[0][0], str) else "long"
        df = spark.createDataFrame(data, f"id {kind}, features array<double>")
        return df.repartition(parts)

    return build


@pytest.fixture(scope="session")
def trips_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def random_points(make_points):
    import numpy as np

    def build(n, d=2, seed=1):
        rng = np.random.default_rng(seed)
        x = rng.random((n, d))
        x[: n // 3] = x[: n // 3] * 0.1 + 0.4
        return x, make_points([tuple(r) for r in x])

    return build


def pairs_of(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


__all__ = ["F"]
