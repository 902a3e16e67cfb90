"""Registered queries of model comparison, calibration, the frozen strategy and what it is worth.

Full-size fits of many training sets take minutes; the README lists their times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcast.learn import design as D
from callcast.learn import ordered as O
from callcast.learn import strategy as S
from callcast.learn import trees as T
from callcast.operators import evaluate as EV
from callcast.operators import resample as RS
from callcast.plans import ml as ML
from callcast.plans.queries import _SCORED, W, _dev_test, _scored, contacts, register
from callcast.schema import CATEGORICAL_COLUMNS
from callcast.session import scratch_path

NUMERIC = [c for c in ML.NUMERIC_COLUMNS if c != "duration"]
RAW = [*NUMERIC, *CATEGORICAL_COLUMNS]
REPEATS = ["fold_43", "fold_44"]

# The candidates that enter the blend.
LOGISTIC = S.Family(S.LOGISTIC.name, "logistic", ((0.2,),))
FOREST = S.Family(S.FOREST.name, "forest", ((None, 5),), 300)
LEAFWISE = S.Family(S.LEAFWISE.name, "leafwise", ((0.03, 15, 0.0),), 250)
NATIVE = S.Family(S.NATIVE.name, "native", ((4, 0.03, 3.0),), 400)
# End of fixed values.


def _once(cache: dict, spark: SparkSession, sf: str, make):
    key = (spark.sparkContext.applicationId, sf)
    if key not in cache:
        cache[key] = make()
    return cache[key]


# ---------------------------------------------------------------- comparison
def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Class-weighted logistic grid over both repeats of five folds."""
    return S.cross_validate(_dev_test(spark, sf)[0], [S.LOGISTIC], NUMERIC, CATEGORICAL_COLUMNS, REPEATS)


def _prior(dev: DataFrame) -> DataFrame:
    """A constant score has an average precision equal to the fold's share of positives."""
    folds = dev.select("label", F.explode(F.array(*[F.struct(F.lit(c).alias("r"), F.col(c).alias("f")) for c in REPEATS])).alias("x")).groupBy("x.r", "x.f").agg(F.avg("label").alias("ap"))
    return folds.agg(F.lit("Prior").alias("model"), F.lit(0).alias("candidate"), F.lit("").alias("parameters"), F.avg("ap").alias("mean_score"), F.stddev_pop("ap").alias("std_score"), F.count(F.lit(1)).alias("folds"))


def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Prior and logistic regression over both repeats."""
    return _prior(_dev_test(spark, sf)[0]).unionByName(model_selection(spark, sf)).orderBy(F.col("mean_score").desc(), "model", "candidate")


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Prior and all four families with their whole grids over both repeats."""
    dev = _dev_test(spark, sf)[0]
    families = [S.LOGISTIC, S.FOREST, S.LEAFWISE, S.NATIVE]
    return _prior(dev).unionByName(S.cross_validate(dev, families, NUMERIC, CATEGORICAL_COLUMNS, REPEATS)).orderBy(F.col("mean_score").desc(), "model", "candidate")


def on_test(spark: SparkSession, sf: str, families) -> DataFrame:
    """Every candidate fitted on the development rows and scored on the test rows."""
    dev, test = _dev_test(spark, sf)
    both = dev.drop(*REPEATS).withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    ready = S.prepare(both, NUMERIC, CATEGORICAL_COLUMNS, ["part"])
    scored = S.fold_scores(families, ready, [D.Fit("test", ((0, 1),))])
    names = spark.createDataFrame([(f.name, c, f.label(c)) for f in families for c in range(len(f.grid))], "model string, candidate int, parameters string")
    return names.join(EV.ranking_metrics_by(scored, ["model", "candidate"]), ["model", "candidate"]).orderBy("model", "candidate")


register("model_selection")(model_selection)
register("cv_summary")(cv_summary)
register("model_comparison")(model_comparison)
register("forest_grid")(lambda spark, sf: on_test(spark, sf, [S.FOREST]))
register("model_zoo")(lambda spark, sf: on_test(spark, sf, [FOREST, LEAFWISE, NATIVE]))


# ---------------------------------------------------------------- ordered statistics
_TS = ("job", "contact", "poutcome")


def ordered_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Mean label of the earlier rows of the same level, for three columns of every contact."""
    c = ML.with_label(contacts(spark, sf)).select("contact_id", "label", *_TS)
    design = D.encode(c, [], _TS)
    learnt = D.learn(design, c, [D.Fit("all")])
    rows = O.statistics_rows(design, [D.Fit("all")], learnt)
    return rows.select(F.col("id").alias("contact_id"), "column_name", F.round("value", 9).alias("statistic"))


register(
    "ordered_statistics",
    W(
        "SELECT contact_id, column_name, ROUND((coalesce(SUM(label) OVER w, 0) + prior) / (COUNT(label) OVER w + 1), 9) AS statistic FROM "
        "(SELECT c.*, AVG(label) OVER () AS prior, md5(contact_id || '-42') AS h FROM (SELECT contact_id, CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, "
        + ", ".join(_TS) + " FROM contacts) c) UNPIVOT (level FOR column_name IN (" + ", ".join(_TS) + ")) "
        "WINDOW w AS (PARTITION BY column_name, level ORDER BY h, contact_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ),
)(ordered_statistics)


# ---------------------------------------------------------------- calibration
_CROSS: dict = {}


def crossed(spark: SparkSession, sf: str) -> S.CrossFit:
    dev = _dev_test(spark, sf)[0].drop("fold_44")
    return _once(_CROSS, spark, sf, lambda: S.cross_fit(dev, [LOGISTIC, FOREST, NATIVE], FOREST.name, NUMERIC, CATEGORICAL_COLUMNS, "fold_43"))


register("calibration_summary")(lambda spark, sf: crossed(spark, sf).summary)
register("calibration_strategy")(lambda spark, sf: S.choose(crossed(spark, sf).summary))


def aligned(spark: SparkSession, sf: str, families) -> DataFrame:
    """Out-of-fold probabilities of several models, one row per development contact."""
    ready = S.prepare(_dev_test(spark, sf)[0], NUMERIC, CATEGORICAL_COLUMNS, ["fold_43"])
    scores = S.fold_scores(families, ready, [D.Fit(str(v), ((0, v),)) for v in range(5)])
    return S.wide_scores(scores, [f.name for f in families], ["id"]).withColumnRenamed("id", "contact_id")


register("align_probabilities")(lambda spark, sf: aligned(spark, sf, [LOGISTIC, FOREST]))
register("align_three_learners")(lambda spark, sf: aligned(spark, sf, [LOGISTIC, FOREST, NATIVE]))


def ablation(spark: SparkSession, sf: str) -> DataFrame:
    """Fold average precision of the forest without each predefined group of columns."""
    from callcast.plans.calibrate import ABLATION_REMOVALS

    dev, out = _dev_test(spark, sf)[0], None
    fits = [D.Fit(str(v), ((0, v),)) for v in range(5)]
    ready = S.prepare(dev, NUMERIC, CATEGORICAL_COLUMNS, ["fold_44"])
    learnt = D.learn(ready.design, ready.df, fits, bins=T.BINS - 1)
    for name, removed in ABLATION_REMOVALS.items():
        some, known = S.narrowed(ready, learnt, [c for c in NUMERIC if c not in removed], [c for c in CATEGORICAL_COLUMNS if c not in removed])
        part = EV.ranking_metrics_by(S.fold_scores([FOREST], some, fits, learnt=known), ["fit"]).select(F.lit(name).alias("feature_set"), "average_precision")
        out = part if out is None else out.unionByName(part)
    summary = out.groupBy("feature_set").agg(F.avg("average_precision").alias("mean_ap"), F.stddev_pop("average_precision").alias("std_ap"))
    whole = summary.where(F.col("feature_set") == next(iter(ABLATION_REMOVALS))).first()["mean_ap"]
    return summary.withColumn("percent_change", (F.col("mean_ap") / F.lit(whole) - 1) * 100).orderBy("feature_set")


register("ablation")(ablation)

# ---------------------------------------------------------------- the frozen strategy
_FROZEN: dict = {}
_QUICK: dict = {}


def frozen(spark: SparkSession, sf: str) -> S.StrategyModel:
    """The chosen strategy of three learners after nested cross-fitting."""
    dev = _dev_test(spark, sf)[0]
    return _once(_FROZEN, spark, sf, lambda: S.freeze(crossed(spark, sf), dev, [LOGISTIC, FOREST, NATIVE], NUMERIC, CATEGORICAL_COLUMNS))


def blended(spark: SparkSession, sf: str) -> S.StrategyModel:
    """A blend of logistic regression and forest whose calibrator and threshold come from out-of-fold rows of the development set.

    The same model as ``frozen`` without its slowest learner and without the comparison of strategies.
    """

    def make():
        dev, families = _dev_test(spark, sf)[0], [LOGISTIC, FOREST]
        names = [f.name for f in families]
        ready = S.prepare(dev, NUMERIC, CATEGORICAL_COLUMNS, ["fold_43"])
        wide = S.wide_scores(S.fold_scores(families, ready, [D.Fit(str(v), ((0, v),)) for v in range(5)]), names, ["id"])
        coef = S.fit_calibrators(wide, names, [None])[None]
        p = S.calibrated(wide, names, F.array(*[F.lit(float(v)) for v in coef]), "p")
        threshold = EV.best_f1_threshold(p.select("label", "p")).first()["threshold"]
        return S.fit_strategy(dev, families, coef, threshold, S.BLEND, NUMERIC, CATEGORICAL_COLUMNS)

    return _once(_QUICK, spark, sf, make)


def _evaluated(model: S.StrategyModel, spark: SparkSession, sf: str) -> DataFrame:
    dev, test = _dev_test(spark, sf)
    return S.held_out(model.transform(test), model.threshold, dev.agg(F.avg("label")).first()[0])


register("heldout_strategy")(lambda spark, sf: _evaluated(frozen(spark, sf), spark, sf))
register("heldout_blend")(lambda spark, sf: _evaluated(blended(spark, sf), spark, sf))


def _report(spark: SparkSession, sf: str) -> DataFrame:
    model, test = blended(spark, sf), _dev_test(spark, sf)[1]
    scored = model.transform(test).select("contact_id", "label", F.col("subscription_probability").alias("p"))
    return EV.lift_table(scored)


register("heldout_lift")(_report)
register("artifact_roundtrip")(lambda spark, sf: S.round_trip(blended(spark, sf), _dev_test(spark, sf)[1], scratch_path(spark, "strategy")))
register("permutation_importance")(lambda spark, sf: S.permutation_importance(blended(spark, sf), _dev_test(spark, sf)[1], RAW))


def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    model, test = blended(spark, sf), _dev_test(spark, sf)[1]
    scored = model.transform(test).select("contact_id", "label", F.col("subscription_probability").alias("p"))
    return RS.bootstrap_ci(scored, model.threshold, n_boot=1000)


register("bootstrap_ci")(bootstrap_ci)


# ---------------------------------------------------------------- the same steps on given scores, checked in SQL
_BP2 = "least(9990, 3 * ((contact_id * 104729) % 1500) + 15 * duration)"


def two_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Both given scores of every contact, from one scan: a join of the table with itself would send an id per row to the driver where Spark takes it for small."""
    rows = EV.scored(contacts(spark, sf), ["duration"])
    return rows.select(F.col("label").cast("double").alias("label"), F.col("p").alias("p_single"), (F.expr(_BP2).cast("int") / F.lit(10000.0)).alias("p_blend"), F.col("p").alias("Forest"))


def strategy_given(spark: SparkSession, sf: str) -> DataFrame:
    """Choice between two strategies on given scores: average precision within the tolerance, then the Brier score."""
    both = two_scores(spark, sf)
    summary = S.strategy_summary(both, ["Forest"]).select("strategy", F.round("oof_pr_auc", 9).alias("oof_pr_auc"), F.round("oof_brier", 9).alias("oof_brier"))
    best = S.choose(summary).select("strategy", F.lit(True).alias("chosen"))
    return summary.join(best, "strategy", "left").select("strategy", "oof_pr_auc", "oof_brier", F.coalesce("chosen", F.lit(False)).alias("chosen"))


_AP = "(SELECT strategy, SUM(pos * tp / (tp + fp)) / SUM(pos) AS ap FROM (SELECT strategy, pos, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM (SELECT strategy, p, SUM(label)::DOUBLE AS pos, (COUNT(*) - SUM(label))::DOUBLE AS neg FROM long GROUP BY strategy, p) WINDOW w AS (PARTITION BY strategy ORDER BY p DESC)) GROUP BY strategy)"
register(
    "strategy_given",
    W(
        "SELECT strategy, oof_pr_auc, oof_brier, coalesce(strategy = (SELECT strategy FROM s WHERE strategy LIKE 'Calibrated%' AND oof_pr_auc >= "
        f"(SELECT MAX(oof_pr_auc) FROM s WHERE strategy LIKE 'Calibrated%') - {S.PR_AUC_TOLERANCE} ORDER BY oof_brier, oof_pr_auc DESC, strategy LIMIT 1), false) AS chosen FROM s",
        _SCORED + f", two AS (SELECT label, p, CAST({_BP2} AS INTEGER) / 10000.0::DOUBLE AS p2, AVG(label) OVER () AS rate FROM scored JOIN contacts USING (contact_id)), "
        f"long AS (SELECT label, '{S.SINGLE}' AS strategy, p FROM two UNION ALL SELECT label, '{S.BLEND}', p2 FROM two UNION ALL SELECT label, 'Raw Forest', p FROM two "
        f"UNION ALL SELECT label, '{S.PREVALENCE}', rate FROM two), "
        f"s AS (SELECT a.strategy, ROUND(a.ap, 9) AS oof_pr_auc, ROUND(b.brier, 9) AS oof_brier FROM {_AP} a JOIN (SELECT strategy, AVG((p - label) * (p - label)) AS brier FROM long GROUP BY strategy) b ON a.strategy = b.strategy)",
    ),
)(strategy_given)


def heldout_given(spark: SparkSession, sf: str) -> DataFrame:
    """Threshold with the highest F1 on four fifths of given scores, frozen and measured on the last fifth."""
    rows = _scored(spark, sf).select("contact_id", F.col("label").cast("double").alias("label"), "p")
    learnt, unseen = rows.where("contact_id % 5 <> 0"), rows.where("contact_id % 5 = 0")
    threshold = EV.best_f1_threshold(learnt).first()["threshold"]
    got = S.held_out(unseen, threshold, learnt.agg(F.avg("label")).first()[0], p="p")
    return got.select("threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "balanced_accuracy", "brier", "brier_baseline", "brier_skill")


register(
    "heldout_given",
    W(
        "SELECT threshold, tp, fp, fn, tn, ROUND(tp / greatest(tp + fp, 1)::DOUBLE, 10) AS precision, ROUND(tp / greatest(tp + fn, 1)::DOUBLE, 10) AS recall, "
        "ROUND(2 * tp / greatest(2 * tp + fp + fn, 1)::DOUBLE, 10) AS f1, ROUND((tp / greatest(tp + fn, 1)::DOUBLE + tn / greatest(tn + fp, 1)::DOUBLE) / 2, 10) AS balanced_accuracy, "
        "ROUND(b, 10) AS brier, ROUND(c, 10) AS brier_baseline, ROUND(1 - b / c, 10) AS brier_skill FROM ("
        "SELECT any_value(threshold) AS threshold, COUNT(*) FILTER (p >= threshold AND label = 1) AS tp, COUNT(*) FILTER (p >= threshold AND label = 0) AS fp, "
        "COUNT(*) FILTER (p < threshold AND label = 1) AS fn, COUNT(*) FILTER (p < threshold AND label = 0) AS tn, AVG((p - label) * (p - label)) AS b, AVG((rate - label) * (rate - label)) AS c "
        "FROM scored, cut WHERE contact_id % 5 = 0)",
        _SCORED + ", g AS (SELECT p, SUM(label)::DOUBLE AS pos, (COUNT(*) - SUM(label))::DOUBLE AS neg FROM scored WHERE contact_id % 5 <> 0 GROUP BY p), "
        "c AS (SELECT p, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS n1, SUM(pos + neg) OVER () AS n FROM g WINDOW w AS (ORDER BY p DESC)), "
        "cut AS (SELECT p AS threshold, n1 / n AS rate FROM c ORDER BY 2 * tp / (tp + fp + n1) DESC, p LIMIT 1)",
    ),
)(heldout_given)
