"""Several streaming queries together: one scheduler pool each, a deadline, totals per query.

A query's own ``recentProgress`` forgets all but its last hundred batches.  The runner reads it while
the queries run and adds every batch up once, by its number, so the totals of a long run are
complete; should more batches end between two looks than are remembered, ``missed`` counts them.
(No listener: a Python listener needs a port of its own for calls from the JVM.)

When one query fails, the others are stopped and its error is raised.  At the deadline all active
queries are stopped; their checkpoints let a later run go on where they were.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from callcast.session import described, scratch_path


@dataclass(frozen=True)
class Job:
    """A streaming frame and where it goes: ``console``, ``memory``, ``parquet`` or ``noop``."""

    name: str
    frame: DataFrame
    mode: str = "append"
    sink: str = "memory"
    checkpoint: str | None = None
    path: str | None = None
    options: dict = field(default_factory=dict)


@dataclass
class Totals:
    batches: int = 0
    input_rows: int = 0
    dropped: int = 0  # rows (after partial aggregation: groups) that came too late for the state
    state_rows: int = 0  # most at once
    state_bytes: int = 0
    last_batch: int = -1
    missed: int = 0
    finished: bool = False

    def add(self, progress) -> None:
        """One batch; a batch that was counted before is ignored."""
        if progress.batchId <= self.last_batch:
            return
        if self.last_batch >= 0:
            self.missed += progress.batchId - self.last_batch - 1
        self.last_batch = progress.batchId
        self.batches += 1
        self.input_rows += progress.numInputRows
        states = progress.stateOperators or []
        self.dropped += sum(s.numRowsDroppedByWatermark or 0 for s in states)
        self.state_rows = max(self.state_rows, sum(s.numRowsTotal or 0 for s in states))
        self.state_bytes = max(self.state_bytes, sum(s.memoryUsedBytes or 0 for s in states))


def start(spark: SparkSession, job: Job, every: str | None = None):
    """Start one query in a pool of its name; without ``every`` it ends when all that is there has been read."""
    writer = job.frame.writeStream.outputMode(job.mode).queryName(job.name)
    writer = writer.option("checkpointLocation", job.checkpoint or scratch_path(spark, f"stream-ckpt-{job.name}"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    for k, v in job.options.items():
        writer = writer.option(k, v)
    if job.sink == "parquet":
        writer = writer.option("path", job.path or scratch_path(spark, f"stream-out-{job.name}"))
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.scheduler.pool")
    sc.setLocalProperty("spark.scheduler.pool", job.name)  # the query's thread inherits it
    try:
        with described(spark, f"stream {job.name}"):
            return writer.format(job.sink).start()
    finally:
        sc.setLocalProperty("spark.scheduler.pool", before)


def run(spark: SparkSession, jobs: Sequence[Job], deadline: float | None = None, every: str | None = None, look: float = 0.2) -> dict[str, Totals]:
    """Run all jobs at once until each has ended or ``deadline`` seconds have passed; (name -> totals)."""
    if len({j.name for j in jobs}) != len(jobs):
        raise ValueError("every job needs a name of its own")
    totals = {j.name: Totals() for j in jobs}
    queries: dict = {}
    end = None if deadline is None else time.monotonic() + deadline

    def read(name: str) -> None:
        for p in queries[name].recentProgress:
            totals[name].add(p)

    try:
        for j in jobs:
            queries[j.name] = start(spark, j, every)
        while True:
            active = [n for n, q in queries.items() if q.isActive]
            for n, q in queries.items():
                read(n)
                error = None if q.isActive else q.exception()
                if error is not None:
                    raise error
            if not active or (end is not None and time.monotonic() >= end):
                break
            # Waits for this one at most ``look`` seconds; it raises the query's own error.
            queries[active[0]].awaitTermination(look if end is None else max(0.01, min(look, end - time.monotonic())))
        for n, q in queries.items():
            totals[n].finished = not q.isActive
    finally:
        for n, q in queries.items():
            if q.isActive:
                q.stop()
            read(n)
    return totals
