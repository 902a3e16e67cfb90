"""Scalar rules on edge values (FIXTURES.md section 2) and a differential check."""

from pyspark.sql import functions as F

from callcast.functions import exprs as X
from callcast.functions.udfs import age_group_udf
from callcast.operators import reports as R
from callcast.sources.strict import scan_strict


def test_age_rules_edges(spark):
    df = spark.createDataFrame([(17,), (18,), (29,), (30,), (60,), (61,), (101,), (None,)], "age int")
    got = {
        r.age: (r.eda, r.audit, r.band, r.g3, r.g3_safe, r.udf)
        for r in df.select(
            "age",
            X.age_bins("age").alias("eda"),
            X.age_bins("age", audit=True).alias("audit"),
            X.age_band5("age").alias("band"),
            X.age_group3("age").alias("g3"),
            X.age_group3("age", null_safe=True).alias("g3_safe"),
            age_group_udf("age").alias("udf"),
        ).collect()
    }
    assert got[17][:2] == (None, None)
    assert got[18][0] == "18-29" and got[29][0] == "18-29" and got[30][0] == "30-39"
    assert got[60][0] == "60+" and got[60][2] == "60+" and got[60][3] == "30-60"
    assert got[101][:2] == (None, "60+")
    assert got[None][3] == ">60" and got[None][4] is None and got[None][5] is None  # V5
    assert got[61][5] == ">60" and got[30][5] == "30-60"


def test_month_rules(spark):
    df = spark.createDataFrame([("jan",), ("dec",), ("foo",), (None,)], "month string")
    got = {
        r.month: (r.o99, r.o13, r.onull, r.q)
        for r in df.select(
            "month",
            X.month_order("month").alias("o99"),
            X.month_order("month", 13).alias("o13"),
            X.month_order("month", None).alias("onull"),
            X.quarter("month").alias("q"),
        ).collect()
    }
    assert got["jan"] == (1, 1, 1, "Q1")
    assert got["dec"] == (12, 12, 12, "Q4")
    assert got["foo"] == (99, 13, None, "Q4")  # V3, V4


def test_guards_and_logit(spark):
    r = spark.range(1).select(
        X.safe_div(F.lit(1.0), F.lit(0)).alias("d0"),
        X.logit(F.lit(1.0)).alias("l1"),
        X.signed_log(F.lit(-9)).alias("sl"),
        X.fmt2(F.lit(2.675)).alias("f"),
    ).first()
    assert r.d0 is None
    assert abs(r.l1 - 13.815509557963773) < 1e-6  # clipped at 1 - 1e-6
    assert abs(r.sl + 2.302585092994046) < 1e-12


def test_strict_label_fails_on_unknown(spark):
    import pytest

    ok = spark.createDataFrame([("yes",), ("no",)], "y string").select(X.strict_label("y").alias("l"))
    assert sorted(r.l for r in ok.collect()) == [0.0, 1.0]
    bad = spark.createDataFrame([("maybe",)], "y string").select(X.strict_label("y"))
    with pytest.raises(Exception):
        bad.collect()


def test_mapreduce_style_equals_dataframe_style(spark, small, small_csv):
    """The strict (mapper rules) path and the typed path give the same report."""
    clean, _ = scan_strict(spark, small_csv)
    a = {r.job: (r.avg_balance, r.clients) for r in R.avg_balance_by_job(clean).collect()}
    b = {r.job: (r.avg_balance, r.clients) for r in R.avg_balance_by_job(small).collect()}
    assert a == b
    # repartitioning by key leaves the result unchanged
    c = {r.job: (r.avg_balance, r.clients) for r in R.avg_balance_by_job(small.repartition(4, "job")).collect()}
    assert c == b
