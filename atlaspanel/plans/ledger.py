"""The step ledger of a refresh: what was done, on which inputs, as which versions.

A refresh is a list of steps; a step writes versions of tables and switches the
names to them. Each finished step is one row of the quality layer's
``step_ledger`` (run, step, tables, versions, at). ``run`` is a digest of the
input files' listing and of everything that decides the rows, so a refresh that
starts again on the same inputs passes over the steps that its unfinished
predecessor has done, as long as their versions are still stored.
"""

from __future__ import annotations

import hashlib
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.sources import sinks

TABLE = "step_ledger"
SCHEMA = "run string, step string, tables array<string>, versions array<string>, at long"
FINISHED = "finished"


def listing_digest(frames: list[DataFrame]) -> str | None:
    """A digest of the files that the frames read: their paths, sizes and times. ``None`` if one reads no file."""
    state = hashlib.sha256()
    for df in frames:
        files = sorted(df.inputFiles())
        if not files:
            return None
        listed = df.sparkSession.read.format("binaryFile").load(files)
        seen = listed.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).cast("string").alias("h")
        ).first()
        state.update(f"{seen['n']},{seen['h']};".encode())
    return state.hexdigest()


def run_digest(listing: str | None, *decided_by) -> str | None:
    """The name of a run: its inputs' listing and the text of what decides its rows."""
    if listing is None:
        return None
    return hashlib.sha256("\n".join([listing, *map(repr, decided_by)]).encode()).hexdigest()


class Ledger:
    """The steps of one run; ``run=None``: nothing is passed over or written down."""

    def __init__(self, spark: SparkSession, layer: str, run: str | None):
        self.spark, self.layer, self.run = spark, layer, run
        self.lock = threading.Lock()
        self.passed: list[str] = []
        self.done: dict[str, list[tuple[str, str, str]]] = {}
        if run is None:
            return
        sinks.ensure_layer(spark, layer)
        self.full = f"`{layer}`.`{TABLE}`"
        if not spark.catalog.tableExists(f"{layer}.{TABLE}"):
            spark.createDataFrame([], SCHEMA).write.format("parquet").saveAsTable(self.full)
        rows = spark.table(self.full).filter(F.col("run") == run).collect()  # a few rows per attempt
        since = max((r["at"] for r in rows if r["step"] == FINISHED), default=0)
        for r in sorted(rows, key=lambda r: r["at"]):
            if r["at"] > since:
                self.done[r["step"]] = [(*t.split(".", 1), v) for t, v in zip(r["tables"], r["versions"])]

    def _stored(self, layer: str, version: str) -> bool:
        return self.spark.catalog.tableExists(f"{layer}.{version}")

    def step(self, name: str, make) -> bool:
        """Run ``make`` unless the step is done; it returns the (layer, table, version) that it wrote.

        The names are switched to the versions here, after all of them are
        complete. Returns whether the step had to be run.
        """
        written = self.done.get(name)
        if written is not None and all(self._stored(layer, version) for layer, _, version in written):
            for layer, table, version in written:  # another run may have switched a name meanwhile
                sinks.point_to(self.spark, layer, table, version)
            with self.lock:
                self.passed.append(name)
            return False
        written = make() or []
        for layer, table, version in written:
            sinks.point_to(self.spark, layer, table, version)
        self._write(name, written)
        return True

    def finish(self) -> None:
        self._write(FINISHED, [])

    def _write(self, step: str, written: list) -> None:
        if self.run is None:
            return
        row = (self.run, step, [f"{layer}.{table}" for layer, table, _ in written], [v for _, _, v in written], time.time_ns())
        with self.lock:  # two appends to one folder must not commit at once
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").format("parquet").saveAsTable(self.full)
