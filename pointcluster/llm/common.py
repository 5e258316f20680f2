"""What the operators share: tables, work folders, row keys and word splitting.

Documents are ``(doc_id, text, ...)``. A null text has no words. Operators read
only the columns they name, so extra columns never clash with theirs; filters
that hand all columns back use internal names checked against the frame's.
Rows are identified by ``(doc_id, hash of id and text)``: repeated rows are
treated alike and each keeps its own row in the result.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NON_WORD_CHARS = "".join(map(chr, (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_ID = -(2**63)
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500

_own_root: list[str] = []


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it (if it is there)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where unset, on one machine, a folder deleted at exit."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _own_root:
        _own_root.append(tempfile.mkdtemp(prefix="pointcluster-llm-"))
        atexit.register(shutil.rmtree, _own_root[0], ignore_errors=True)
    return _own_root[0]


class Tables:
    """Tables of one run in the shared folder; ``close`` deletes them.

    Results may still read them, so whoever consumes the result closes; a run
    that is never closed deletes its folder when the driver exits.
    """

    live: list[Tables] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
        self.n = 0
        Tables.live.append(self)

    def path(self, name: str = "table") -> str:
        if not self.n:
            atexit.register(self.close)
        self.n += 1
        return f"{self.root}/{self.n}-{name}"

    def store(self, df: DataFrame, name: str = "table") -> DataFrame:
        """``df`` written and read back. Rows here can be whole texts and sets, so tasks
        get fewer of them per Arrow batch than the session's default."""
        path, conf = self.path(name), self.spark.conf
        before = conf.get(ARROW_ROWS)
        conf.set(ARROW_ROWS, str(BATCH_ROWS))
        try:
            df.write.parquet(path)
        finally:
            conf.set(ARROW_ROWS, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        if self in Tables.live:
            Tables.live.remove(self)
        if not self.n:
            return
        self.n = 0
        atexit.unregister(self.close)
        try:
            jvm, jsc = self.spark._jvm, self.spark._jsc
            path = jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended: a local folder can still go
            shutil.rmtree(self.root.removeprefix("file://"), ignore_errors=True)


@contextlib.contextmanager
def closing_tables():
    """Close the ``Tables`` that are made inside, once what reads them is stored."""
    before = set(map(id, Tables.live))
    yield
    for tables in [t for t in Tables.live if id(t) not in before]:
        tables.close()


def sliced(batches, rows: int = 500):
    """Arrow batches in slices, so that a task turns few rows into Python objects at once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _give_back() -> None:
    """Freed memory returns to the system: Python workers outlive their tasks."""
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def released(work):
    """``work`` on the batches of a task, then nothing of it stays in the worker."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            _give_back()

    return run


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have yet, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name, i = base, 0
        while name.lower() in taken:
            i += 1
            name = f"{base}_{i}"
        taken.add(name.lower())
        out.append(name)
    return out


def key_columns() -> list[Column]:
    """``_d, _k``: the id (null: a sentinel) and a hash of id and text."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_d"),
        F.xxhash64("doc_id", "text").alias("_k"),
    ]


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(*key_columns(), *more)


def join_by_key(docs: DataFrame, found: DataFrame, how: str) -> tuple[DataFrame, dict]:
    """``docs`` joined with ``found (_d, _k, ...)`` by row key, under names that ``docs``
    does not have; returns the frame and the new name of each column of ``found``."""
    own = free_names(docs, "_d", "_k", *[f"_r{c}" for c in found.columns])
    d, k = key_columns()
    left = docs.select("*", d.alias(own[0]), k.alias(own[1]))
    names = dict(zip(found.columns, own[2:]))
    right = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    on = (F.col(own[0]) == F.col(names["_d"])) & (F.col(own[1]) == F.col(names["_k"]))
    return left.join(right, on, how).drop(own[0], own[1]), names


def words(text: Column, pattern: str = SPACES, chars: str = SPACE_CHARS) -> Column:
    """Words of ``text`` between runs of separators; null and empty give none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(chars))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, pattern))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())
