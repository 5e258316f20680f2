"""Rounds of an iterative job, committed one by one, so that a restarted driver goes on.

A log is a folder all executors share: ``run`` holds the run's parameters and its starting
centers, ``round-<n>`` the history row and the centers after round n. Each is a small JSON
table, written beside its place and put there by one rename (``functions.durable.replace``),
so a round is there as a whole or not at all. Rounds count up to the first one missing.

A log of other parameters is an error, as is one of other starting centers; nothing in it is
overwritten. ``tol`` and the number of rounds are no part of it: a finished run may be
continued with more rounds. The points must be the same; they are not compared.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..functions.durable import replace

RUN_SCHEMA = "parameters string, centers array<array<double>>"
ROUND_SCHEMA = "iter int, shift double, n_dist long, seconds double, centers array<array<double>>"


class RoundLog:
    def __init__(self, spark: SparkSession, folder: str, parameters: dict):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.parameters = json.dumps(parameters, sort_keys=True)

    def _write(self, name: str, row: tuple, schema: str) -> None:
        frame = self.spark.createDataFrame([row], schema).coalesce(1)
        replace(self.spark, f"{self.folder}/{name}", frame.write.json)

    def _names(self) -> set[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()

    def start(self) -> list[list[float]] | None:
        """The starting centers of the run in the folder, if there is one."""
        if "run" not in self._names():
            return None
        row = self.spark.read.schema(RUN_SCHEMA).json(f"{self.folder}/run").first()
        if row["parameters"] != self.parameters:
            raise ValueError(f"{self.folder} holds a run with other parameters: {row['parameters']}")
        return row["centers"]

    def open(self, centers: list[list[float]]) -> tuple[list, list, list[tuple]]:
        """Centers after the last round, centers before it, and the history so far."""
        known = self.start()
        if known is None:
            self._write("run", (self.parameters, centers), RUN_SCHEMA)
        elif known != centers:
            raise ValueError(f"{self.folder} holds a run from other starting centers")
        names, done = self._names(), 0
        while f"round-{done + 1}" in names:
            done += 1
        if not done:
            return centers, centers, []
        paths = [f"{self.folder}/round-{n + 1}" for n in range(done)]
        rows = sorted(self.spark.read.schema(ROUND_SCHEMA).json(paths).collect())
        previous = rows[-2]["centers"] if done > 1 else centers
        return rows[-1]["centers"], previous, [tuple(r)[:4] for r in rows]

    def commit(self, row: tuple, centers: list[list[float]]) -> None:
        self._write(f"round-{row[0]}", (*row, centers), ROUND_SCHEMA)


def round_log(
    points: DataFrame, folder: str | None, method: str, k, seed, limit, init, empty, shift_norm
) -> RoundLog | None:
    if folder is None:
        return None
    given = init if init is None or isinstance(init, str) else [list(map(float, c)) for c in init]
    parameters = dict(
        method=method, k=k, seed=seed, limit=limit, init=given, empty=empty, shift_norm=shift_norm
    )
    return RoundLog(points.sparkSession, folder, parameters)
