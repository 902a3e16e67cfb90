"""Cross-fitted probability calibration, strategy choice, ablation,
permutation importance and the artifact round trip.

All model fits are Spark ML jobs; the driver loops over folds, models and
feature sets (a few dozen iterations) and only collects per-fold metrics.
"""

from __future__ import annotations

import json
from typing import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.functions.exprs import logit
from callcast.operators import evaluate as EV
from callcast.operators import split as SP
from callcast.operators.resample import permute_columns
from callcast.plans import ml as ML
from callcast.session import materialize

# Calibration and selection rules.
CALIBRATION_C = 1.0
PR_AUC_TOLERANCE = 0.005
# End of fixed values.


def align_probabilities(frames: Mapping[str, DataFrame], id_col: str = "contact_id") -> DataFrame:
    """One row per id, one ``p_<model>`` column per model: joined on the id, never by position."""
    out = None
    for name, f in frames.items():
        part = f.select(id_col, "label", F.col("p").alias(f"p_{name}"))
        out = part if out is None else out.join(part.drop("label"), id_col)
    return out


def _fit_calibrator(df: DataFrame, prob_cols: Sequence[str], n: int) -> PipelineModel:
    """Logistic layer on logits; sklearn's C maps to Spark's regParam = 1 / (C n)."""
    feats = df.select("label", *[logit(c).alias(f"logit_{c}") for c in prob_cols])
    stages = [
        VectorAssembler(inputCols=[f"logit_{c}" for c in prob_cols], outputCol="features"),
        LogisticRegression(labelCol="label", featuresCol="features", regParam=1.0 / (CALIBRATION_C * n),
                           elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-8),
    ]
    return Pipeline(stages=stages).fit(feats)


def _apply_calibrator(model: PipelineModel, df: DataFrame, prob_cols: Sequence[str], out: str) -> DataFrame:
    feats = df.select("*", *[logit(c).alias(f"logit_{c}") for c in prob_cols])
    scored = model.transform(feats)
    keep = [c for c in df.columns]
    return scored.select(*keep, vector_to_array("probability")[1].alias(out))


def cross_fit_calibration(
    dev: DataFrame,
    pipelines: Mapping[str, Pipeline],
    outer_col: str,
    outer_k: int = 5,
    inner_k: int = 4,
    inner_seed_base: int = 62,
    id_col: str = "contact_id",
) -> tuple[DataFrame, DataFrame, dict]:
    """Two-level cross-fitting.

    1. OOF probability of every base model on the outer folds.
    2. Best single model = highest OOF AP.
    3. For each outer fold: inner ``inner_k``-fold OOF of every base model on
       the outer-training rows fits a single-model and a blend calibrator
       (logistic on logits); they score the outer fold's OOF probabilities.
    4. Final calibrators are fitted on all OOF rows.

    Returns (calibrated OOF frame, summary of the three strategies, info).
    """
    names = list(pipelines)
    oof = align_probabilities({m: ML.oof_predict(dev, pipelines[m], outer_col, id_col, outer_k) for m in names}, id_col)
    oof = oof.join(dev.select(id_col, F.col(outer_col).alias("_outer")), id_col)
    ap = EV.ranking_metrics_by(
        oof.select("label", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("p")) for m in names])).alias("x"))
        .select("label", "x.model", "x.p"),
        ["model"],
    )
    best = ap.orderBy(F.col("average_precision").desc(), "model").first()["model"]
    single_cols, blend_cols = [f"p_{best}"], [f"p_{m}" for m in names]

    parts = []
    for o in range(outer_k):
        train = dev.where(F.col(outer_col) != o)
        n_train = train.count()
        inner = SP.kfold_assign(train, k=inner_k, seeds=(inner_seed_base + o,), label_col="label", prefix="_inner")
        inner_col = f"_inner_{inner_seed_base + o}"
        inner_oof = align_probabilities({m: ML.oof_predict(inner, pipelines[m], inner_col, id_col, inner_k) for m in names}, id_col)
        cal_single = _fit_calibrator(inner_oof, single_cols, n_train)
        cal_blend = _fit_calibrator(inner_oof, blend_cols, n_train)
        fold_rows = oof.where(F.col("_outer") == o)
        fold_rows = _apply_calibrator(cal_single, fold_rows, single_cols, "p_single")
        fold_rows = _apply_calibrator(cal_blend, fold_rows, blend_cols, "p_blend")
        parts.append(fold_rows)
    calibrated = parts[0]
    for p in parts[1:]:
        calibrated = calibrated.unionByName(p)
    calibrated = materialize(calibrated, "calibrated")
    n_dev = dev.count()
    if calibrated.select(id_col).distinct().count() != n_dev:
        raise RuntimeError("calibration left incomplete out-of-fold probabilities")

    prevalence = dev.agg(F.avg("label")).first()[0]
    strategies = calibrated.select(
        "label",
        F.explode(
            F.array(
                F.struct(F.lit("Prevalence baseline").alias("strategy"), F.lit(float(prevalence)).alias("p")),
                F.struct(F.lit(f"Uncalibrated best single ({best})").alias("strategy"), F.col(f"p_{best}").alias("p")),
                F.struct(F.lit("Calibrated best single").alias("strategy"), F.col("p_single").alias("p")),
                F.struct(F.lit("Calibrated OOF blend").alias("strategy"), F.col("p_blend").alias("p")),
            )
        ).alias("s"),
    ).select("label", "s.strategy", "s.p")
    brier = strategies.groupBy("strategy").agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("oof_brier"))
    summary = EV.ranking_metrics_by(strategies, ["strategy"]).join(brier, "strategy").select(
        "strategy", F.col("average_precision").alias("oof_pr_auc"), "oof_brier"
    )
    final_single = _fit_calibrator(oof, single_cols, n_dev)
    final_blend = _fit_calibrator(oof, blend_cols, n_dev)
    info = {"best_single": best, "final_single": final_single, "final_blend": final_blend,
            "single_cols": single_cols, "blend_cols": blend_cols}
    return calibrated, summary, info


def choose_strategy(summary: DataFrame, tolerance: float = PR_AUC_TOLERANCE) -> DataFrame:
    """Among calibrated strategies within ``tolerance`` AP of the best: lowest Brier, then highest AP."""
    cal = summary.where(F.col("strategy").isin("Calibrated best single", "Calibrated OOF blend"))
    best_ap = cal.agg(F.max("oof_pr_auc")).first()[0]
    return (
        cal.where(F.col("oof_pr_auc") >= F.lit(best_ap - tolerance))
        .orderBy(F.col("oof_brier").asc(), F.col("oof_pr_auc").desc(), "strategy")
        .limit(1)
    )


# The ablation feature sets (removals from the pre-call features).
ABLATION_REMOVALS = {
    "All pre-call features": (),
    "Without poutcome": ("poutcome",),
    "Without previous-contact history": ("poutcome", "pdays", "previous"),
    "Without contact channel": ("contact",),
    "Without age": ("age",),
}
# End of fixed values.


def ablation(dev: DataFrame, fold_col: str, model_type: str = "forest", k: int = 5, **estimator_kw) -> DataFrame:
    """Per feature set: mean / population std of fold AP and percent change against all features."""
    from callcast.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS

    numeric = [c for c in NUMERIC_COLUMNS if c != "duration"]
    rows = []
    spark = dev.sparkSession
    for name, removed in ABLATION_REMOVALS.items():
        num = [c for c in numeric if c not in removed]
        cat = [c for c in CATEGORICAL_COLUMNS if c not in removed]
        pipe = ML.build_pipeline(model_type, numeric=num, categorical=cat, clip=False, features=True, impute=True, **estimator_kw)
        oof = ML.oof_predict(dev.drop(*removed), pipe, fold_col, k=k)
        for r in EV.ranking_metrics_by(oof, ["fold"]).collect():  # k rows
            rows.append((name, int(r["fold"]), float(r["average_precision"])))
    scores = spark.createDataFrame(rows, "feature_set string, fold int, ap double")
    summ = scores.groupBy("feature_set").agg(F.avg("ap").alias("mean_ap"), F.stddev_pop("ap").alias("std_ap"))
    ref = summ.where(F.col("feature_set") == "All pre-call features").select(F.col("mean_ap").alias("_ref"))
    ref_v = ref.first()["_ref"]
    return summ.withColumn("percent_change", (F.col("mean_ap") / F.lit(ref_v) - 1) * 100).orderBy("feature_set")


def permutation_importance(
    model: PipelineModel, test: DataFrame, features: Sequence[str], repeats: int = 10, top: int = 12, seed: int = 42
) -> DataFrame:
    """AP drop per raw feature over ``repeats`` shuffles: mean and population std, top ``top``.

    All (feature, repeat) permutations are stacked in one frame, scored in one
    transform and evaluated with one keyed ranking job.
    """
    base_ap = EV.ranking_metrics(ML.positive_probability(model.transform(test))).first()["average_precision"]
    stacked = permute_columns(test, features, repeats, seed)
    scored = ML.positive_probability(model.transform(stacked)).select("perm_feature", "perm_repeat", "label", "p")
    per = EV.ranking_metrics_by(scored, ["perm_feature", "perm_repeat"])
    return (
        per.select("perm_feature", (F.lit(base_ap) - F.col("average_precision")).alias("drop"))
        .groupBy(F.col("perm_feature").alias("feature"))
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.col("importance_mean").desc(), "feature")
        .limit(top)
    )


def artifact_roundtrip(model: PipelineModel, test: DataFrame, path: str, meta: Mapping[str, object], id_col: str = "contact_id") -> DataFrame:
    """Save model + one-row JSON metadata, reload both, and compare predictions by id.

    Returns (check, passed, detail) rows: predictions equal (max |diff| < 1e-9)
    over every test row, and metadata equal.
    """
    spark = test.sparkSession
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(dict(meta), sort_keys=True, default=str),)], "meta string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/meta")
    again = PipelineModel.load(f"{path}/model")
    meta_back = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    a = ML.positive_probability(model.transform(test)).select(id_col, F.col("p").alias("p1"))
    b = ML.positive_probability(again.transform(test)).select(id_col, F.col("p").alias("p2"))
    d = a.join(b, id_col, "full_outer").agg(
        F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"),
        F.sum((F.col("p1").isNull() | F.col("p2").isNull()).cast("long")).alias("unmatched"),
        F.count(F.lit(1)).alias("rows"),
    )
    same_meta = meta_back == json.loads(json.dumps(dict(meta), sort_keys=True, default=str))
    return d.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("predictions_equal").alias("check"),
                    ((F.coalesce(F.col("max_abs_diff"), F.lit(0.0)) < 1e-9) & (F.col("unmatched") == 0)).alias("passed"),
                    F.concat(F.lit("rows="), F.col("rows").cast("string"), F.lit(" max_abs_diff="),
                             F.coalesce(F.col("max_abs_diff"), F.lit(0.0)).cast("string")).alias("detail"),
                ),
                F.struct(F.lit("metadata_equal").alias("check"), F.lit(same_meta).alias("passed"), F.lit("json").alias("detail")),
            )
        ).alias("c")
    ).select("c.*")
