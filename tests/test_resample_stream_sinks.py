"""Bootstrap, permutations, streaming watermark behaviour, sinks, artifacts."""

import datetime as dt

from pyspark.sql import functions as F

from callcast.operators.evaluate import scored
from callcast.operators.resample import bootstrap_ci, permute_columns
from callcast.plans import ml as ML
from callcast.plans.calibrate import artifact_roundtrip
from callcast.session import scratch_path
from callcast.sources.contacts import contacts
from callcast.sources.sinks import create_csv_table, save_report, save_tsv
from callcast.streaming import jobs as SJ
from callcast.operators import reports as R

from sf_dirs import SF


def test_bootstrap_is_partition_independent(spark):
    s = scored(contacts(spark, SF))
    a = {r.metric: (r.lower_95, r.upper_95) for r in bootstrap_ci(s, 0.5, n_boot=200).collect()}
    b = {r.metric: (r.lower_95, r.upper_95) for r in bootstrap_ci(s.repartition(5), 0.5, n_boot=200).collect()}
    assert a == b
    lo, hi = a["PR-AUC"]
    assert 0 < lo < hi < 1


def test_permutation_keeps_each_column_multiset(spark, small):
    feats = ["age", "job"]
    p = permute_columns(small, feats, repeats=3)
    assert p.count() == small.count() * len(feats) * 3
    for f in feats:
        orig = sorted(r[0] for r in small.select(f).collect())
        for rep in range(3):
            got = sorted(r[0] for r in p.where((F.col("perm_feature") == f) & (F.col("perm_repeat") == rep)).select(f).collect())
            assert got == orig
    # a column that is not being permuted stays with its own row
    j = p.where(F.col("perm_feature") == "age").select("contact_id", "job").join(small.select("contact_id", F.col("job").alias("j0")), "contact_id")
    assert j.where(F.col("job") != F.col("j0")).count() == 0


def _timed_rows(n, late_extra=False):
    """FIXTURES section 5 timing rule: 4 s apart, each 37th row 3 minutes early."""
    base = dt.datetime(2026, 4, 22, 10, 0, 0)
    rows = []
    for i in range(n):
        t = base + dt.timedelta(seconds=4 * i)
        if i % 37 == 0:
            t -= dt.timedelta(minutes=3)
        rows.append((t, "job", float(i)))
    return rows


def test_watermark_drop_counts_one_old_row(spark, tmp_path):
    schema = "event_time timestamp, job string, balance double"
    folder = str(tmp_path / "stream")
    import os
    import time

    rows = _timed_rows(8 * 150)
    for k in range(8):
        chunk = rows[k * 150:(k + 1) * 150]
        if k == 4:
            chunk = chunk + [(dt.datetime(2026, 4, 22, 10, 0, 0), "job", -1.0)]
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    st = SJ.file_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    _, prog = SJ.drain(SJ.stream_window(st, "1 minute"), "append")
    assert prog["rows_dropped_by_watermark"] == 1
    assert os.path.isdir(folder)


def test_stream_metrics_equal_batch(spark):
    from callcast.sources.tables import table

    ev = SJ.events_as_contacts(table(spark, SF, "events"))
    path = SJ.write_replay_files(ev, 4, "event_time")
    got, _ = SJ.drain(SJ.stream_job_metrics(SJ.file_stream(spark, path, ev.schema, max_files_per_trigger=1)), "complete")
    want = SJ.stream_job_metrics(ev)
    a = {r.job: (r.transaction_count, round(r.avg_balance, 9)) for r in got.collect()}
    b = {r.job: (r.transaction_count, round(r.avg_balance, 9)) for r in want.collect()}
    assert a == b


def test_sinks_roundtrip(spark, small, small_csv):
    out = scratch_path(spark, "tsv")
    save_tsv(R.avg_balance_by_job(small), out, "job", "avg_balance", "clients")
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert "retired\t2933.33\t3" in lines
    rep = scratch_path(spark, "report")
    save_report(R.avg_balance_by_job(small), rep)
    assert spark.read.option("header", True).csv(rep).count() == 7
    t = create_csv_table(spark, "client_info", small_csv)
    assert t.count() == 12 and dict(t.dtypes)["balance"] == "int"


def test_artifact_roundtrip(spark):
    c = ML.with_label(contacts(spark, SF))
    model = ML.build_pipeline("logistic", maxIter=10, features=True, impute=True).fit(c)
    checks = {r.check: r.passed for r in artifact_roundtrip(model, c, scratch_path(spark, "art"), {"threshold": 0.5}).collect()}
    assert checks == {"predictions_equal": True, "metadata_equal": True}


def test_feature_builder_skips_missing_columns(spark, small):
    out = ML.FeatureBuilder().transform(small.drop("poutcome", "pdays"))
    assert "previous_campaign_success" not in out.columns and "previously_contacted" not in out.columns
    pipe = ML.build_pipeline("logistic", numeric=["age", "balance"], categorical=["job"], features=True, maxIter=5)
    model = pipe.fit(ML.with_label(small))
    assert model.transform(ML.with_label(small)).count() == 12


def test_balanced_weights(spark, small):
    w = ML.balanced_weights(ML.with_label(small))
    got = {r.label: r.weight for r in w.select("label", "weight").distinct().collect()}
    # 5 yes and 7 no of 12: weights 12 / (2 * count)
    assert got == {1.0: 12 / 10, 0.0: 12 / 14}
    assert abs(sum(r.weight for r in w.collect()) - 12) < 1e-9
    assert ML.c_to_reg_param(0.2, 1000) == 1 / 200


def test_windows_do_not_depend_on_session_time_zone(spark):
    from callcast.sources.tables import table

    def windows():
        ev = SJ.events_as_contacts(table(spark, SF, "events"))
        return sorted((r.window_start, r.transaction_count) for r in SJ.batch_window(ev, "1 day").collect())

    utc = windows()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        other = windows()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other
    assert all(w.hour == 0 and w.minute == 0 for w, _ in utc)


def test_json_summary_sink(spark):
    from callcast.sources.sinks import save_summary

    path = scratch_path(spark, "summary")
    save_summary(spark, {"age_balance_correlation": 0.5, "best_contact_method": "cellular"}, path)
    row = spark.read.json(path).first()
    assert row.best_contact_method == "cellular" and row.age_balance_correlation == 0.5
