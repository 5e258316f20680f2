"""Reliable storage for iterative jobs.

Frames that later rounds build on are written as tables below the shared folder
named by ``spark.checkpoint.dir``: the lineage is cut, an executor may be lost
at any time, and the next plan starts from real file sizes. (A checkpoint keeps
the estimates and constraints of the plan behind it, which grow with every
round of joins until planning takes longer than the job.)

Only a local master without that setting (a test on one machine) gets a folder
of its own, deleted when the driver exits; a cluster without it is an error, as
executors share no disk. The session's own settings are never changed.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it (if it is there)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="pointcluster-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = path or scratch_path(df.sparkSession, "frame")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    jvm, jsc = spark._jvm, spark._jsc
    path = jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """``write`` a table to a folder beside ``path``, then put it in the place of what is there.

    Until the new table is complete the old one is untouched, so a write that fails or is
    killed leaves the old rows readable, and a table may be replaced by what is read from
    it. A switch that is cut off between its two renames leaves the old table as
    ``<path>.old-*``; ``recover`` puts it back.
    """
    path = path.rstrip("/")
    staged, old = (f"{path}.{name}-{uuid.uuid4().hex}" for name in ("staged", "old"))
    try:
        write(staged)
    except BaseException:
        delete(spark, staged)
        raise
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = fs.exists(at(path))
    if there and not fs.rename(at(path), at(old)):
        delete(spark, staged)
        raise OSError(f"cannot move {path}")
    if not fs.rename(at(staged), at(path)):
        if there:
            fs.rename(at(old), at(path))
        delete(spark, staged)
        raise OSError(f"cannot put a table at {path}")
    if there:
        fs.delete(at(old), True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put back the table that an interrupted ``replace`` had moved away, if there is one."""
    path = path.rstrip("/")
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(path)):
        return False
    left = fs.globStatus(at(f"{path}.old-*")) or []
    return len(left) == 1 and fs.rename(left[0].getPath(), at(path))


class Workspace:
    """The intermediate tables of one run; ``close`` deletes them."""

    def __init__(self, spark: SparkSession):
        workers_find_package(spark)
        self.spark = spark
        self.root = scratch_path(spark, "work")
        self.n = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.n += 1
        return stored(df, f"{self.root}/{self.n}")

    def close(self) -> None:
        if self.n:
            delete(self.spark, self.root)
            self.n = 0
