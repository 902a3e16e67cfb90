"""Exact ranking and threshold metrics on (label, p) frames.

Ranking metrics need running totals over the sorted score.  The rows are
first grouped by score (one row per distinct score, map-side combined), and
the running totals over the descending score come from ``ordered.running``
(range partitioning + per-partition pass + a one-row-per-partition carry).
No step moves all rows, or all scores, into one task.

Definitions (same as scikit-learn's):

* average precision = sum over distinct thresholds (high to low) of
  (R_k - R_{k-1}) * P_k, no interpolation (NOT Spark's areaUnderPR);
* ROC-AUC = Mann-Whitney U / (P * N), ties count one half;
* precision / recall / F1 with zero_division = 0; predictions are p >= t.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcast.functions.exprs import AGE_LABELS, age_bins
from callcast.operators.ordered import running, running_counts
from callcast.operators.quantiles import exact_percentiles


def scored(contacts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Deterministic scores for testing metrics against SQL (FIXTURES ``scored``).

    Integer basis points keep sums exact in every engine.  ``keep`` names
    contact columns to carry along.
    """
    bp = F.least(F.lit(9990), F.lit(5) * ((F.col("contact_id") * 7919) % 1000) + F.lit(10) * F.col("duration"))
    return contacts.select(
        "contact_id",
        F.when(F.col("y") == "yes", 1).otherwise(0).alias("label"),
        bp.cast("int").alias("score_bp"),
        (bp / F.lit(10000.0)).alias("p"),
        *keep,
    )


def score_counts(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """One row per distinct score: pos, neg, and running TP/FP from the top score down."""
    g = df.groupBy(F.col(p).alias("p")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"),
    )
    r = running_counts(g.withColumn("_neg_p", -F.col("p")), [], ["_neg_p"], ["pos", "neg"])
    return r.select("p", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))


def _metric_aggs(thresholds: Sequence[float] = ()) -> list[Column]:
    """Aggregates over ``score_counts`` rows: totals, AP numerator, U part, TP/FP per threshold."""
    aggs = [
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap_num"),
        # U = sum pos * (negatives below + neg / 2) = N * P + sum pos * (neg / 2 - fp)
        F.sum(F.col("pos") * (F.col("neg") / 2.0 - F.col("fp"))).alias("u_part"),
    ]
    for i, t in enumerate(thresholds):
        keep = F.col("p") >= F.lit(float(t))
        aggs += [
            F.sum(F.when(keep, F.col("pos")).otherwise(0)).alias(f"tp_{i}"),
            F.sum(F.when(keep, F.col("neg")).otherwise(0)).alias(f"fp_{i}"),
        ]
    return aggs


def _ranking_cols(digits: int) -> list[Column]:
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    return [
        F.col("P").cast("long").alias("positives"),
        F.col("N").cast("long").alias("negatives"),
        F.round(F.col("ap_num") / P, digits).alias("average_precision"),
        F.round((N * P + F.col("u_part")) / (P * N), digits).alias("roc_auc"),
    ]


def ranking_metrics(df: DataFrame, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """One row: positives, negatives, average_precision, roc_auc."""
    return score_counts(df, p, label).agg(*_metric_aggs()).select(*_ranking_cols(digits))


def pr_curve(df: DataFrame, p: str = "p", label: str = "label", digits: int | None = 10) -> DataFrame:
    """Precision, recall and F1 at every distinct score (predict p >= threshold); ``digits=None`` leaves them unrounded."""
    rounded = lambda c: c if digits is None else F.round(c, digits)
    c = score_counts(df, p, label)
    total_pos = c.agg(F.sum("pos").alias("P"))
    # P is a one-row aggregate; read it as a literal for the per-row recall.
    P = total_pos.first()["P"] or 0
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / F.lit(float(P)) if P else F.lit(1.0)
    f1 = 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.lit(float(P)))  # a ratio of whole numbers: equal values are equal
    return c.select(
        F.col("p").alias("threshold"),
        F.col("tp").cast("long").alias("tp"),
        F.col("fp").cast("long").alias("fp"),
        rounded(prec).alias("precision"),
        rounded(rec).alias("recall"),
        rounded(f1).alias("f1"),
    )


def best_f1_threshold(df: DataFrame, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """The threshold with the highest F1 (compared unrounded); ties go to the lowest threshold."""
    best = pr_curve(df, p, label, digits=None).orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)
    return best.select("threshold", "tp", "fp", *[F.round(x, digits).alias(x) for x in ("precision", "recall", "f1")])


def _confusion_aggs(pred: Column, y: Column, tag: str) -> list[Column]:
    return [
        F.sum((pred & (y == 1)).cast("long")).alias(f"tp{tag}"),
        F.sum((pred & (y == 0)).cast("long")).alias(f"fp{tag}"),
        F.sum((~pred & (y == 1)).cast("long")).alias(f"fn{tag}"),
        F.sum((~pred & (y == 0)).cast("long")).alias(f"tn{tag}"),
    ]


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(tp.cast("double"), F.nullif(tp + fp, F.lit(0))), zero)
    recall = F.coalesce(F.try_divide(tp.cast("double"), F.nullif(tp + fn, F.lit(0))), zero)
    f1 = F.coalesce(F.try_divide(2 * tp.cast("double"), F.nullif(2 * tp + fp + fn, F.lit(0))), zero)
    spec = F.coalesce(F.try_divide(tn.cast("double"), F.nullif(tn + fp, F.lit(0))), zero)
    return {"precision": precision, "recall": recall, "f1": f1, "balanced_accuracy": (recall + spec) / 2}


def threshold_metrics(df: DataFrame, threshold: float = 0.5, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall, f1, balanced accuracy at ``threshold``."""
    pred = F.col(p) >= F.lit(threshold)
    a = df.agg(*_confusion_aggs(pred, F.col(label), ""))
    r = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return a.select(
        F.lit(float(threshold)).alias("threshold"), "tp", "fp", "fn", "tn",
        *[F.round(v, digits).alias(k) for k, v in r.items()],
    )


def threshold_table(
    df: DataFrame,
    selected: float | None = None,
    fixed: Sequence[float] = (0.10, 0.20, 0.50),
    p: str = "p",
    label: str = "label",
    digits: int = 4,
) -> DataFrame:
    """Metrics at each of {fixed..., selected}; ``selected`` defaults to the best-F1 threshold.

    All thresholds are evaluated in ONE aggregate pass (conditional sums).
    """
    if selected is None:
        selected = best_f1_threshold(df, p, label).first()["threshold"]
    ts = sorted(set([float(t) for t in fixed] + [float(selected)]))
    a = df.agg(*[agg for i, t in enumerate(ts) for agg in _confusion_aggs(F.col(p) >= F.lit(t), F.col(label), f"_{i}")])
    rows = []
    for i, t in enumerate(ts):
        r = _rates(F.col(f"tp_{i}"), F.col(f"fp_{i}"), F.col(f"fn_{i}"), F.col(f"tn_{i}"))
        rows.append(
            F.struct(
                F.lit(t).alias("threshold"),
                F.round(r["precision"], digits).alias("precision"),
                F.round(r["recall"], digits).alias("recall"),
                F.round(r["f1"], digits).alias("f1"),
                F.lit(math.isclose(t, selected, abs_tol=1e-8)).alias("selected"),
            )
        )
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def classification_metrics(df: DataFrame, threshold: float = 0.5, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """PR-AUC, ROC-AUC and the threshold metrics in one row, from one aggregate
    over the score-grouped counts (TP/FP at the threshold are conditional sums)."""
    a = score_counts(df, p, label).agg(*_metric_aggs([threshold]))
    tp, fp = F.col("tp_0"), F.col("fp_0")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    r = _rates(tp, fp, fn, tn)
    return a.select(
        *_ranking_cols(digits),
        F.lit(float(threshold)).alias("threshold"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"), tn.cast("long").alias("tn"),
        *[F.round(v, digits).alias(k) for k, v in r.items()],
    )


def lift_table(
    df: DataFrame,
    shares: Sequence[float] = (0.10, 0.20, 0.30),
    p: str = "p",
    label: str = "label",
    id_col: str = "contact_id",
    digits: int = 10,
) -> DataFrame:
    """Top ceil(n * share) rows by score (id breaks ties): rate, lift, capture.

    Global rank from ``ordered.running`` over (-p, id); one aggregate with a
    conditional sum per share.
    """
    n = df.count()
    ranked = running(df.select(F.col(id_col), (-F.col(p)).alias("_neg_p"), F.col(label).alias("_y")), [], ["_neg_p", id_col])
    cuts = [(s, int(math.ceil(n * s))) for s in shares]
    a = ranked.agg(
        F.sum("_y").alias("_pos"),
        *[F.sum(F.when(F.col("row_number") <= k, F.col("_y")).otherwise(0)).alias(f"_t{i}") for i, (s, k) in enumerate(cuts)],
    )
    base = F.col("_pos") / F.lit(float(n))
    rows = [
        F.struct(
            F.lit(s).alias("contact_share"),
            F.lit(k).cast("long").alias("customers_contacted"),
            F.round(F.col(f"_t{i}") / F.lit(float(k)), digits).alias("subscription_rate"),
            F.round(F.col(f"_t{i}") / F.lit(float(k)) / base, digits).alias("lift_over_random"),
            F.round(F.col(f"_t{i}") / F.col("_pos"), digits).alias("subscriber_capture_rate"),
        )
        for i, (s, k) in enumerate(cuts)
    ]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def classification_report(df: DataFrame, threshold: float = 0.5, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """Per class precision, recall, f1, support; accuracy; macro and weighted averages."""
    pred = F.col(p) >= F.lit(threshold)
    a = df.agg(*_confusion_aggs(pred, F.col(label), ""))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    pos = _rates(tp, fp, fn, tn)
    neg = _rates(tn, fn, fp, tp)  # class 0 seen as the positive class
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1

    def row(name, pr, rc, f1, sup):
        return F.struct(
            F.lit(name).alias("class"),
            F.round(pr, digits).alias("precision"),
            F.round(rc, digits).alias("recall"),
            F.round(f1, digits).alias("f1"),
            sup.cast("long").alias("support"),
        )

    rows = [
        row("0", neg["precision"], neg["recall"], neg["f1"], s0),
        row("1", pos["precision"], pos["recall"], pos["f1"], s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), (tp + tn) / n, n),
        row("macro avg", (neg["precision"] + pos["precision"]) / 2, (neg["recall"] + pos["recall"]) / 2, (neg["f1"] + pos["f1"]) / 2, n),
        row(
            "weighted avg",
            (neg["precision"] * s0 + pos["precision"] * s1) / n,
            (neg["recall"] * s0 + pos["recall"] * s1) / n,
            (neg["f1"] * s0 + pos["f1"] * s1) / n,
            n,
        ),
    ]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def brier(df: DataFrame, base_rate: float | None = None, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """Brier score, the constant-prevalence baseline and the skill score.

    ``base_rate`` is the DEVELOPMENT prevalence (the baseline predicts it for
    every row); by default the frame's own prevalence.
    """
    y = F.col(label).cast("double")
    r = F.avg(y) if base_rate is None else F.lit(float(base_rate))
    a = df.agg(
        F.avg(F.pow(F.col(p) - y, 2)).alias("b"),
        r.alias("r"),
        F.avg(y).alias("m"),
    )
    # mean((r - y)^2) = r^2 - 2 r m + m  for 0/1 labels with mean m
    bb = F.col("r") * F.col("r") - 2 * F.col("r") * F.col("m") + F.col("m")
    return a.select(
        F.round("b", digits).alias("brier"),
        F.round(bb, digits).alias("brier_baseline"),
        F.round(1 - F.col("b") / bb, digits).alias("brier_skill"),
    )


def calibration_curve(df: DataFrame, n_bins: int = 8, p: str = "p", label: str = "label", digits: int = 10) -> DataFrame:
    """Quantile bins of the score: mean predicted p and observed rate per non-empty bin.

    Edges are exact interpolated percentiles (one row, read as literals);
    a row's bin is the number of inner edges strictly below its score.
    """
    qs = [k / n_bins for k in range(1, n_bins)]
    found = exact_percentiles(df, [p], qs).first()  # one row
    edges = [found[f"q{i}"] for i in range(len(qs))] if found else []
    b = sum((F.col(p) > F.lit(float(e))).cast("int") for e in edges) if edges else F.lit(0)
    return (
        df.groupBy(b.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.avg(F.col(p)), digits).alias("mean_predicted"),
            F.round(F.avg(F.col(label).cast("double")), digits).alias("observed_rate"),
        )
        .orderBy("bin")
    )


def subgroup_audit(
    df: DataFrame,
    threshold: float,
    fields: Sequence[str] = ("contact", "poutcome", "age_band"),
    p: str = "p",
    label: str = "label",
    small: int = 25,
    digits: int = 10,
) -> DataFrame:
    """(field, grp) -> rows, actual and predicted positive rates, recall, precision.

    ``df`` carries the group columns (``age`` for ``age_band``, audit bins).
    Recall / precision are NULL when their denominator is 0; ``small_group``
    flags groups under ``small`` rows.  One unpivot + one grouped aggregate.
    """
    def value(f):
        return age_bins("age", audit=True) if f == "age_band" else F.col(f).cast("string")

    pred = (F.col(p) >= F.lit(threshold)).cast("int")
    st = df.select(
        F.col(label).cast("int").alias("_y"),
        pred.alias("_p"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), value(f).alias("grp")) for f in fields])).alias("g"),
    ).select("g.field", "g.grp", "_y", "_p").where(F.col("grp").isNotNull())
    agg = st.groupBy("field", "grp").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("_y").alias("actual_positive_rate"),
        F.avg("_p").alias("predicted_positive_rate"),
        F.sum(F.col("_y") * F.col("_p")).alias("_tp"),
        F.sum("_y").alias("_ap"),
        F.sum("_p").alias("_pp"),
    )
    if "age_band" in fields:
        labels = df.sparkSession.createDataFrame([("age_band", lab) for lab in AGE_LABELS], "field string, grp string")
        agg = agg.join(labels, ["field", "grp"], "full_outer").fillna(0, subset=["rows", "_tp", "_ap", "_pp"])
    return agg.select(
        "field",
        "grp",
        F.col("rows").cast("long").alias("rows"),
        F.round("actual_positive_rate", digits).alias("actual_positive_rate"),
        F.round("predicted_positive_rate", digits).alias("predicted_positive_rate"),
        F.round(F.try_divide(F.col("_tp").cast("double"), F.nullif(F.col("_ap"), F.lit(0))), digits).alias("recall"),
        F.round(F.try_divide(F.col("_tp").cast("double"), F.nullif(F.col("_pp"), F.lit(0))), digits).alias("precision"),
        (F.col("rows") < small).alias("small_group"),
    ).orderBy("field", "grp")


def ranking_metrics_by(df: DataFrame, keys: Sequence[str], p: str = "p", label: str = "label") -> DataFrame:
    """``ranking_metrics`` per group (e.g. per model, fold or permutation), in one job.

    Score-grouped counts per (keys, p), then running totals inside each key
    from ``ordered.running`` (a hot group is range-split like any other).
    """
    keys = list(keys)
    g = df.groupBy(*[F.col(k) for k in keys], F.col(p).alias("p")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"),
    )
    r = running_counts(g.withColumn("_neg_p", -F.col("p")), keys, ["_neg_p"], ["pos", "neg"])
    return (
        r.groupBy(*keys)
        .agg(
            F.sum("pos").alias("P"),
            F.sum("neg").alias("N"),
            F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("ap_num"),
            F.sum(F.col("pos") * (F.col("neg") / 2.0 - F.col("cum_neg"))).alias("u_part"),
        )
        .select(
            *keys,
            (F.col("ap_num") / F.col("P")).alias("average_precision"),
            ((F.col("N") * F.col("P") + F.col("u_part")) / (F.col("P") * F.col("N"))).alias("roc_auc"),
        )
    )
