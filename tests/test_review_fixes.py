"""Cases from the review: wide integers, many levels, several files, exact percentiles, one parse per line."""

import math
import re

import pytest
from pyspark.sql import functions as F

from callcast.functions.exprs import age_band5, month_order, quarter
from callcast.operators import evaluate as EV
from callcast.operators import resample as RS
from callcast.operators import split as SP
from callcast.operators import stats as ST
from callcast.operators.ordered import running
from callcast.operators.quantiles import exact_percentiles
from callcast.operators.reports import avg_balance_by_job_desc, avg_balance_by_job_partitioned, crosstab
from callcast.schema import CONTACT_COLUMNS
from callcast.sources.strict import scan_strict
from callcast.sources.tables import scan_contacts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_keeps_wide_integers_beside_nulls(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big, "a"), (2, None, "b"), (3, big + 2, None)], "id long, v long, s string")
    got = {r.id: (r.v, r.prev_v, r.prev_s) for r in running(df, [], ["id"], lags=["v", "s"]).collect()}
    assert got == {1: (big, None, None), 2: (None, big, "a"), 3: (big + 2, None, "b")}


def test_split_has_no_python_and_no_checkpoint(spark, small):
    text = plan(SP.stratified_split(small))
    assert not re.search("Python|Pandas|Arrow|Scan ExistingRDD.*_h", text)


def test_split_with_null_label(spark):
    df = spark.range(500).select(F.col("id").alias("contact_id"), F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("yes")).alias("y"))
    out = SP.stratified_split(df)
    counts = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts == {(None, "train"): 60, (None, "validation"): 20, (None, "test"): 20, ("yes", "train"): 240, ("yes", "validation"): 80, ("yes", "test"): 80}


def test_chi_square_with_many_levels_and_closed_form(spark):
    df = spark.range(60_000).select((F.col("id") % 30_000).cast("string").alias("a"), F.when(F.col("id") < 30_000, "x").otherwise("y").alias("b"))
    r = ST.chi_square(df, "a", "b").first()
    assert r.dof == 29_999 and r.chi2 == pytest.approx(0, abs=1e-6) and r.p_value == pytest.approx(1.0)
    two = spark.createDataFrame([("a", "x")] * 12 + [("a", "y")] * 5 + [("b", "x")] * 3 + [("b", "y")] * 9, "a string, b string")
    r = ST.chi_square(two, "a", "b").first()
    n, cells, e = 29, (12, 5, 3, 9), (17 * 15 / 29, 17 * 14 / 29, 12 * 15 / 29, 12 * 14 / 29)
    assert r.chi2 == pytest.approx(sum((abs(o - x) - 0.5) ** 2 / x for o, x in zip(cells, e)), rel=1e-9)
    assert r.n == n and r.p_value == pytest.approx(math.erfc(math.sqrt(r.chi2 / 2)), rel=1e-9)


@pytest.mark.parametrize("x,dof,want", [(2.0, 2, math.exp(-1)), (3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05), (0.0, 3, 1.0), (18.307038053275146, 10, 0.05)])
def test_chi2_tail(x, dof, want):
    assert ST.chi2_sf(x, dof) == pytest.approx(want, rel=1e-9)


def test_exact_percentiles(spark):
    rows = [("a", float((i * 37) % 101), i % 2) for i in range(101)] + [(None, 5.0, 0), (None, None, 1), ("b", None, 0)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    qs = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    got = {(r.column_name, r.g): r for r in exact_percentiles(df, ["v", "w"], qs, by=["g"]).collect()}
    for (c, g), r in got.items():
        one = df.where(F.col("g").eqNullSafe(F.lit(g))).agg(F.percentile(F.col(c).cast("double"), qs)).first()[0]
        assert [r[f"q{i}"] for i in range(len(qs))] == pytest.approx(one, abs=1e-12)
    assert set(got) == {("v", "a"), ("w", "a"), ("v", None), ("w", None), ("w", "b")}


def test_ids_do_not_depend_on_file_packing(spark, tmp_path):
    line = "{},services,single,secondary,no,{},yes,yes,unknown,9,may,80,2,-1,0,unknown,no"
    for name, n, base in (("a", 2, 0), ("b", 60, 100), ("c", 7, 300)):
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(CONTACT_COLUMNS), *(line.format(20 + i % 50, base + i) for i in range(n))]) + "\n")
    want = list(range(0, 2)) + list(range(100, 160)) + list(range(300, 307))
    for size in ("134217728", "600"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = scan_contacts(spark, str(tmp_path)).select("contact_id", "balance").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r.balance for r in sorted(rows, key=lambda r: r.contact_id)] == want
        assert sorted(r.contact_id for r in rows) == list(range(1, 70))


def test_strict_scan_parses_once(spark, small_csv):
    clean, quarantine = scan_strict(spark, small_csv)
    assert plan(clean).count("from_csv") + plan(clean).count("csvtostructs") <= 2
    assert clean.count() == 12 and quarantine.count() == 0


def test_best_f1_is_compared_unrounded(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") / n).alias("p"), (F.col("id") >= n // 2).cast("int").alias("label"))
    assert EV.best_f1_threshold(df).first().threshold == 0.5


def test_poisson_reaches_the_end_of_its_distribution(spark):
    draws = spark.createDataFrame([(0.0,), (0.36,), (0.37,), (0.9999999999999999,)], "u double").select(RS.poisson1(F.col("u")).alias("k")).collect()
    assert [r.k for r in draws][:3] == [0, 0, 1] and draws[3].k > 12


def test_partitioned_average_and_crosstab(spark, small):
    a = [tuple(r) for r in avg_balance_by_job_desc(small).collect()]
    assert a == [tuple(r) for r in avg_balance_by_job_partitioned(small, 40).collect()]
    cells = {(r.contact, r.y): r["count"] for r in crosstab(small).collect()}
    assert sum(cells.values()) == 12 and cells["unknown", "yes"] == 0


def test_scalar_bins(spark):
    rows = spark.createDataFrame([(m, a) for m, a in (("jan", 29), ("mar", 30), ("apr", 39), ("sep", 40), ("oct", 59), ("dec", 60), ("xyz", None), (None, 18))], "m string, a int")
    got = rows.select(month_order("m").alias("o"), quarter("m").alias("q"), age_band5("a").alias("b"), age_band5("a", null_safe=True).alias("n")).collect()
    assert [r.o for r in got] == [1, 3, 4, 9, 10, 12, 99, 99]
    assert [r.q for r in got] == ["Q1", "Q1", "Q2", "Q3", "Q4", "Q4", "Q4", "Q4"]
    assert [r.b for r in got] == ["18-29", "30-39", "30-39", "40-49", "50-59", "60+", "60+", "18-29"]
    assert got[6].n is None


def test_bootstrap_equals_plain_replicates(spark):
    """Every replicate of the running sums against average precision computed row by row."""
    import numpy as np

    rows = [(i, float((i * 7919) % 60) / 60, int((i * i) % 7 < 2)) for i in range(900)]
    df = spark.createDataFrame(rows, "contact_id long, p double, label int").repartition(5)
    out = {r.metric: r for r in RS.bootstrap_ci(df, 0.5, n_boot=60).collect()}
    w = RS._counts(np.array([r[0] for r in rows]), 60, 42)
    p, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    ap, recall = [], []
    for b in range(60):
        whole, num, pos, neg = (w[:, b] * y).sum(), 0.0, 0.0, 0.0
        for t in sorted(set(p), reverse=True):
            here = p == t
            gained = (w[here, b] * y[here]).sum()
            pos, neg = pos + gained, neg + (w[here, b] * (1 - y[here])).sum()
            num += gained * pos / (pos + neg) if pos + neg else 0.0
        ap.append(num / whole)
        recall.append((w[:, b] * y * (p >= 0.5)).sum() / whole)
    assert out["PR-AUC"].replicates == 60
    assert (out["PR-AUC"].lower_95, out["PR-AUC"].upper_95) == pytest.approx(tuple(np.quantile(ap, [0.025, 0.975])), abs=1e-9)
    assert (out["Recall"].lower_95, out["Recall"].upper_95) == pytest.approx(tuple(np.quantile(recall, [0.025, 0.975])), abs=1e-9)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05


def test_crosstab_refuses_too_many_levels(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("a"), (F.col("id") % 20).cast("string").alias("b"))
    assert crosstab(df, "a", "b", max_levels=20).count() == 1000
    with pytest.raises(ValueError):
        crosstab(df, "a", "b", max_levels=19)


def test_split_integrity_counts_ids_without_a_join(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "contact_id long")
    source = ids(1, 2, 3, 4, 4, None)
    got = SP.split_integrity({"a": ids(1, 2, 9), "b": ids(2, 2, 8, None)}, source)
    assert "Join" not in plan(got)
    assert [tuple(r) for r in got.collect()] == [("no_overlap", False, 1), ("covers_source", False, 4), ("no_foreign_rows", False, 3)]
    assert got.dtypes == [("check", "string"), ("passed", "boolean"), ("offending_ids", "bigint")]
    good = SP.split_integrity({"a": ids(1, 2), "b": ids(3)}, ids(1, 2, 3))
    assert [tuple(r) for r in good.collect()] == [("no_overlap", True, 0), ("covers_source", True, 0), ("no_foreign_rows", True, 0)]
    none = SP.split_integrity({"a": ids()}, ids())
    assert [tuple(r) for r in none.collect()] == [("no_overlap", True, 0), ("covers_source", True, 0), ("no_foreign_rows", True, 0)]


def test_two_given_scores_come_from_one_scan(spark):
    from callcast.plans import strategy_queries as Q
    from callcast.sources.contacts import contacts

    from sf_dirs import SF

    both = Q.two_scores(spark, SF)
    assert "Join" not in plan(both)
    joined = EV.scored(contacts(spark, SF)).join(contacts(spark, SF).select("contact_id", (F.expr(Q._BP2).cast("int") / F.lit(10000.0)).alias("p2")), "contact_id")
    want = joined.select(F.col("label").cast("double"), "p", "p2", "p")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, want.collect()))


def test_tuning_learns_the_preprocessing_once_per_fold(spark, monkeypatch):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from callcast.plans import ml as ML
    from callcast.plans.queries import _train_test

    from sf_dirs import SF

    monkeypatch.setattr(ML, "LR_GRID", {"regParam": [0.0, 0.1], "elasticNetParam": [0.5]})
    monkeypatch.setattr(ML, "LR_MAX_ITER", 8)
    train = SP.kfold_assign(_train_test(spark, SF)[0], k=ML.CV_FOLDS, seeds=(ML.SEED,)).limit(3000).localCheckpoint()
    pipeline = ML.build_pipeline("logistic")
    est = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 0.1]).addGrid(est.elasticNetParam, [0.5]).build()
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    want = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=ML.CV_FOLDS, foldCol=f"fold_{ML.SEED}").fit(train)
    fits, fit = [], ML.OutlierClipper._fit
    monkeypatch.setattr(ML.OutlierClipper, "_fit", lambda self, df: (fits.append(1), fit(self, df))[1])
    got, best = ML.tuned_logistic(train, fold_col=f"fold_{ML.SEED}")
    assert len(fits) == ML.CV_FOLDS + 1
    assert got.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-9)
    assert best.stages[-1].coefficients.toArray() == pytest.approx(want.bestModel.stages[-1].coefficients.toArray(), abs=1e-6)
    with pytest.raises(ValueError):
        ML.tuned_logistic(train.withColumn(f"fold_{ML.SEED}", F.lit(0)), fold_col=f"fold_{ML.SEED}")
