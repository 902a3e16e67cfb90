"""Streaming runner: several queries at once, totals, deadline, failing query, late rows; job descriptions and tags; clipping."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from callcast.plans import ml as ML
from callcast.session import cancel, described
from callcast.streaming import jobs as SJ
from callcast.streaming import runner

SCHEMA = "event_id long, event_time timestamp, job string, balance double, duration int"


def events(spark, n=400, minutes=1):
    base = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60 * minutes)
    return spark.range(n).select(F.col("id").alias("event_id"), base.alias("event_time"), F.concat(F.lit("j"), F.col("id") % 3).alias("job"), F.col("id").cast("double").alias("balance"), F.lit(1).alias("duration"))


@pytest.fixture
def folder(spark, tmp_path):
    SJ.with_flush(events(spark)).repartitionByRange(6, "event_time").write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_four_queries_at_once_give_the_batch_results(spark, folder, tmp_path):
    stream = lambda: SJ.file_stream(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=2)
    jobs = [
        runner.Job("t_metrics", SJ.stream_job_metrics(stream().where("job IS NOT NULL")), "complete", "memory"),
        runner.Job("t_window", SJ.stream_window(stream(), "1 hour"), "append", "parquet", path=str(tmp_path / "w")),
        runner.Job("t_large", stream().where("balance > 300").select("event_id"), "append", "parquet", path=str(tmp_path / "l")),
        runner.Job("t_console", SJ.stream_job_metrics(stream().where("job IS NOT NULL")), "complete", "console"),
    ]
    got = runner.run(spark, jobs)
    assert all(t.finished and t.missed == 0 and t.batches >= 3 for t in got.values()), got
    assert got["t_metrics"].input_rows == 401 and got["t_large"].input_rows >= 99  # the filter is pushed into the scan
    assert {r.job: r.transaction_count for r in spark.table("t_metrics").collect()} == {"j0": 134, "j1": 133, "j2": 133}
    want = {(r.window_start, r.transaction_count) for r in SJ.batch_window(events(spark), "1 hour").collect()}
    assert {(r.window_start, r.transaction_count) for r in spark.read.parquet(str(tmp_path / "w")).collect()} == want
    assert spark.read.parquet(str(tmp_path / "l")).count() == 99
    assert got["t_window"].state_rows > 0 and got["t_console"].batches == got["t_metrics"].batches
    assert not spark.streams.active


def test_deadline_stops_all_and_a_later_run_goes_on(spark, folder, tmp_path):
    stream = SJ.file_stream(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    job = lambda n: runner.Job(n, stream.select("event_id"), "append", "parquet", str(tmp_path / f"c{n}"), str(tmp_path / f"o{n}"))
    began = time.monotonic()
    got = runner.run(spark, [job("d_one"), job("d_two")], deadline=3, every="1 second")
    assert time.monotonic() - began < 60 and not spark.streams.active and not any(t.finished for t in got.values())
    runner.run(spark, [job("d_one"), job("d_two")])
    for n in ("d_one", "d_two"):
        assert spark.read.parquet(str(tmp_path / f"o{n}")).distinct().count() == spark.read.parquet(str(tmp_path / f"o{n}")).count() == 401


def test_a_failing_query_stops_the_others(spark, folder):
    stream = SJ.file_stream(spark, folder, spark.read.parquet(folder).schema, max_files_per_trigger=1)
    bad = runner.Job("f_bad", stream.select(F.raise_error(F.lit("broken on purpose")).alias("x")), "append", "noop")
    good = runner.Job("f_good", stream.select("event_id"), "append", "noop")
    with pytest.raises(Exception, match="broken on purpose"):
        runner.run(spark, [good, bad], every="1 second")
    assert not spark.streams.active
    with pytest.raises(ValueError):
        runner.run(spark, [good, good])


class Batch:
    def __init__(self, n, rows, dropped):
        self.batchId, self.numInputRows = n, rows
        self.stateOperators = [type("S", (), {"numRowsDroppedByWatermark": dropped, "numRowsTotal": 5 + n, "memoryUsedBytes": 10})()]


def test_totals_count_every_batch_once_and_notice_gaps():
    t = runner.Totals()
    for n in (0, 1, 1, 0, 2, 5):
        t.add(Batch(n, 10, n))
    assert (t.batches, t.input_rows, t.dropped, t.missed, t.state_rows) == (4, 40, 8, 2, 10)


def test_late_rows_are_those_of_closed_windows(spark):
    ev = events(spark, 600)
    row = SJ.late_rows(ev, F.col("event_id") % 10 == 0).first()
    last = 599 * 60 + 1_700_000_000 - 120
    ends = [(1_700_000_000 + i * 60) // 3600 * 3600 + 3600 for i in range(0, 600, 10)]
    assert row.late_rows == sum(e <= last for e in ends) > 0
    assert row.input_rows == 600 and row.counted_rows == 600 - row.late_rows and row.state_rows > 0


def _jobs(spark, tag):
    return list(spark.sparkContext._jsc.sc().statusTracker().getJobIdsForTag(tag))


def test_descriptions_and_tags_are_set_and_taken_back(spark):
    sc = spark.sparkContext
    sc.setJobDescription("outer")
    with described(spark, "inner text", tag="tag-a"):
        spark.range(10).count()
    with pytest.raises(ZeroDivisionError):
        with described(spark, "failing", tag="tag-b"):
            1 / 0
    assert sc.getLocalProperty("spark.job.description") == "outer" and not sc.getJobTags()
    ids = _jobs(spark, "tag-a")
    assert ids and not _jobs(spark, "tag-b")
    store = sc._jsc.sc().statusStore()
    assert {store.job(i).description().get() for i in ids} == {"inner text"}
    sc.setJobDescription(None)


def test_cancel_by_tag_stops_only_its_jobs(spark):
    errors = []

    def slow():
        try:
            with described(spark, "slow", tag="tag-slow"):
                spark.range(0, 8, 1, 8).selectExpr("java_method('java.lang.Thread', 'sleep', 60000L)").collect()
        except Exception as e:
            errors.append(str(e))

    thread = threading.Thread(target=slow)
    thread.start()
    until = time.monotonic() + 30
    while not _jobs(spark, "tag-slow") and time.monotonic() < until:
        time.sleep(0.1)
    cancel(spark, "tag-slow")
    thread.join(50)
    assert not thread.is_alive() and errors
    assert spark.range(5).count() == 5


def test_clipper_learns_ranks_and_clips(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("b"), F.lit(None).cast("int").alias("c"))
    model = ML.OutlierClipper(inputCols=["a", "b", "c"]).fit(df)
    err = ML.sketch_rank_error(ML.CLIP_SKETCH)
    lo, hi = model.getOrDefault("lower"), model.getOrDefault("upper")
    assert abs(lo[0] / 20_000 - 0.01) <= 2 * err and abs(hi[0] / 20_000 - 0.99) <= 2 * err
    out = model.transform(df)
    r = out.agg(F.min("a"), F.max("a"), F.count("b"), F.count("c"), F.count(F.lit(1))).first()
    assert (r[0], r[1]) == (lo[0], hi[0]) and r[2] == 6667 and r[3] == 0 and r[4] == 20_000
    inside = df.where((F.col("a") > lo[0]) & (F.col("a") < hi[0])).count()
    assert out.where((F.col("a") > lo[0]) & (F.col("a") < hi[0])).count() == inside
