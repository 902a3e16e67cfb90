"""Structured Streaming jobs: live KPIs, event-time windows, live scoring.

Sources are file streams (Parquet or CSV folders); tests and the query
registry drain them with ``trigger(availableNow=True)``, a live deployment
uses ``processingTime``.  Every sink is given a ``checkpointLocation`` under
``spark.checkpoint.dir`` so a restarted query resumes from its offsets and
state instead of reprocessing or losing data.

State: the job metrics keep one row per job; the windowed counts keep one row
per open window and drop it once the watermark (max event time - delay)
passes the window end, so state stays bounded on an endless stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callcast.session import checkpoint_root, scratch_path


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def ntz_as_utc(col: str, df: DataFrame):
    """TIMESTAMP_NTZ -> TIMESTAMP instant whose UTC wall time is the NTZ value.

    Watermarks need TIMESTAMP; reading the wall time as UTC keeps window
    boundaries (aligned in UTC) independent of the session time zone.
    """
    return F.from_utc_timestamp(F.col(col).cast("timestamp"), _session_tz(df))


def _utc_wall(c, df: DataFrame):
    """Inverse of ``ntz_as_utc`` for output columns: the instant's UTC wall time as NTZ."""
    return F.to_utc_timestamp(c, _session_tz(df)).cast("timestamp_ntz")


def events_as_contacts(events: DataFrame) -> DataFrame:
    """Map the driver's ``events`` rows onto the stream columns.

    event_time = ts as a TIMESTAMP (a watermark needs TIMESTAMP, not NTZ),
    job = event_type, balance = value, duration = INT of props.k.
    """
    return events.select(
        F.col("event_id"),
        ntz_as_utc("ts", events).alias("event_time"),
        F.col("event_type").alias("job"),
        F.col("value").alias("balance"),
        F.get_json_object("props", "$.k").cast("int").alias("duration"),
        F.col("user_id"),
    )


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_job_metrics(stream: DataFrame) -> DataFrame:
    """Unbounded group by job: average balance, average duration, count (complete mode)."""
    return stream.groupBy("job").agg(
        F.avg("balance").alias("avg_balance"),
        F.avg("duration").alias("avg_duration"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def stream_window(stream: DataFrame, width: str, watermark: str = "2 minutes", time_col: str = "event_time") -> DataFrame:
    """Tumbling event-time windows: count and average balance (append mode).

    Rows older than the watermark are dropped and closed windows leave the
    state store.  Window bounds are returned as TIMESTAMP_NTZ (UTC wall time,
    see ``ntz_as_utc``).
    """
    return _tumbling(stream.withWatermark(time_col, watermark), width, time_col)


def batch_window(df: DataFrame, width: str, time_col: str = "event_time") -> DataFrame:
    """Batch twin of ``stream_window``: every window, no watermark."""
    return _tumbling(df, width, time_col)


def _tumbling(df: DataFrame, width: str, time_col: str) -> DataFrame:
    return (
        df.groupBy(F.window(time_col, width).alias("window"))
        .agg(F.count(F.lit(1)).alias("transaction_count"), F.avg("balance").alias("avg_balance"))
        .select(
            _utc_wall(F.col("window.start"), df).alias("window_start"),
            _utc_wall(F.col("window.end"), df).alias("window_end"),
            "transaction_count",
            "avg_balance",
        )
    )


def with_flush(df: DataFrame, time_col: str = "event_time", gap: str = "INTERVAL 10 DAYS") -> DataFrame:
    """``df`` and one row far after its last event, empty but for its time.

    A replay of it drives the watermark past every window of ``df``, so an
    append-mode run closes them all; the window of the added row stays open and
    is never put out.
    """
    end = df.agg((F.max(time_col) + F.expr(gap)).alias(time_col))
    return df.unionByName(end.where(F.col(time_col).isNotNull()), allowMissingColumns=True)


def stream_predict(model, stream: DataFrame, keep=("event_time", "age", "job", "balance", "duration", "y")) -> DataFrame:
    """Score a stream with a fitted ``PipelineModel`` (all stages are map-only)."""
    from pyspark.ml.functions import vector_to_array

    cols = [c for c in keep if c in stream.columns]
    return model.transform(stream).select(
        *cols, "prediction", vector_to_array("probability")[1].alias("subscription_probability")
    )


def drain(query_df: DataFrame, mode: str, name: str | None = None, sink: str = "memory",
          checkpoint: str | None = None) -> tuple[DataFrame, dict]:
    """Run a streaming plan over everything available, then return the stored result.

    ``sink='memory'`` (small aggregates) or ``'parquet'`` (row output; files
    under the checkpoint root).  Returns (result DataFrame, last progress).
    """
    spark = query_df.sparkSession
    checkpoint_root(spark)
    name = name or f"q_{uuid.uuid4().hex[:10]}"
    ckpt = checkpoint or scratch_path(spark, f"stream-ckpt-{name}")
    writer = query_df.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True)
    if sink == "memory":
        q = writer.format("memory").start()
        q.awaitTermination()
        progress = _progress(q)
        return spark.table(name), progress
    out = scratch_path(spark, f"stream-out-{name}")
    q = writer.format("parquet").option("path", out).start()
    q.awaitTermination()
    progress = _progress(q)
    return spark.read.parquet(out), progress


def _progress(q) -> dict:
    dropped = 0
    batches = 0
    for p in q.recentProgress:
        batches += 1
        for s in p.stateOperators or []:
            dropped += s.numRowsDroppedByWatermark or 0
    return {"batches": batches, "rows_dropped_by_watermark": dropped}


def write_replay(df: DataFrame, order_col: str, name: str = "replay", partitions: int | None = None) -> str:
    """A (derived) table as a stream source folder, range-partitioned on time.

    Written by all tasks in parallel; read it without ``maxFilesPerTrigger``
    (one ``availableNow`` batch) so file modification times do not matter.
    Safe at any size: no slice passes through one task.
    """
    path = scratch_path(df.sparkSession, name)
    ranged = df.repartitionByRange(partitions, order_col) if partitions else df.repartitionByRange(order_col)
    ranged.sortWithinPartitions(order_col).write.parquet(path)
    return path


def write_replay_files(df: DataFrame, n_files: int, order_col: str, name: str = "replay") -> str:
    """Cut a SMALL table into ``n_files`` time slices, one file each, oldest first.

    A file source replays files by modification time, so the slices are
    written one after another (slice k = rows between the k-th and (k+1)-th
    quantile of ``order_col``; the quantiles are one aggregate).  Each slice
    is one file written by one task: for bounded fixture replays that exercise
    micro-batches and the watermark (tests); use ``write_replay`` for data
    of any size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    t = F.unix_micros(F.col(order_col)) if dict(df.dtypes)[order_col] == "timestamp" else F.col(order_col).cast("double")
    keyed = df.withColumn("_t", t)
    edges = keyed.agg(F.percentile_approx("_t", [k / n_files for k in range(1, n_files)], 10_000).alias("e")).first()["e"]
    bounds = [None, *sorted(set(edges)), None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("_t") >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col("_t") < F.lit(hi))
        keyed.where(cond).drop("_t").coalesce(1).sortWithinPartitions(order_col).write.mode("append").parquet(path)
    return path


def late_rows(events: DataFrame, late, width: str = "1 hour", watermark: str = "2 minutes", time_col: str = "event_time") -> DataFrame:
    """Replay ``events`` with the rows that ``late`` (a condition) selects arriving last, and count what the windows leave out.

    Four runs go on from one checkpoint, each with new files: the rows in time; their last moment once
    more (so that the watermark is past them); the late rows; a row far ahead that closes all windows.
    One row: input_rows, counted_rows (in the closed windows), late_rows (the others), batches, state_rows.
    ``late_rows`` counts rows; Spark's own metric counts groups, as late rows meet the state after partial aggregation.
    """
    from callcast.streaming import runner

    spark = events.sparkSession
    folder, out, ckpt = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "ckpt"))
    is_late = F.coalesce(late, F.lit(False))
    in_time = events.where(~is_late)
    last = in_time.agg(F.max(time_col).alias(time_col))
    again = in_time.join(F.broadcast(last), time_col, "left_semi").limit(1)  # one row
    closing = with_flush(events, time_col).join(F.broadcast(events.agg(F.max(time_col).alias("_last"))), F.col(time_col) > F.col("_last")).drop("_last")
    totals, name = [], f"late_{uuid.uuid4().hex[:8]}"
    for part in (in_time, again, events.where(is_late), closing):
        part.write.mode("append").parquet(folder)
        stream = stream_window(file_stream(spark, folder, events.schema), width, watermark, time_col)
        totals.append(runner.run(spark, [runner.Job(name, stream, "append", "parquet", ckpt, out)])[name])
    # Of the rows put in twice or added for the replay, the repeated last moment is counted and the closing row is not.
    counted = spark.read.parquet(out).agg(F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("c")).first()["c"] - again.count()
    rows = events.count()
    return spark.createDataFrame(
        [(rows, int(counted), rows - int(counted), sum(t.batches for t in totals), max(t.state_rows for t in totals))],
        "input_rows long, counted_rows long, late_rows long, batches int, state_rows long",
    )
