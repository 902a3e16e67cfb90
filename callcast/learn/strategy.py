"""Model families on shared folds, cross-fitted calibration, and one scoring model of it all.

``fold_scores`` fits every candidate of a family on every training set side by side and scores the
rows that each set left out.  ``cross_fit`` does this on two levels (outer folds, and inner folds inside
each outer training set) and calibrates: the outer rows' calibrators are learnt from inner scores only.
``StrategyModel`` holds the base models, the calibrator, the threshold and the column list; it is
a Spark ML model, so it scores frames and streams in one narrow transform and is saved and loaded.
"""

from __future__ import annotations

import io
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.learn import design as D
from callcast.learn import linear as L
from callcast.learn import ordered as O
from callcast.learn import trees as T
from callcast.operators import evaluate as EV
from callcast.operators import split as SP
from callcast.plans.ml import DERIVED_SOURCES, FeatureBuilder, cv_summary
from callcast.session import arrow_rows, described, disposable, materialize, ship_package


@dataclass(frozen=True)
class Family:
    """A kind of model and its grid: a tuple of parameters per candidate."""

    name: str
    kind: str  # logistic, forest, leafwise, native
    grid: tuple
    size: int = 0  # trees or rounds

    def label(self, c: int) -> str:
        names = {"logistic": ("C",), "forest": ("max_depth", "min_leaf"), "leafwise": ("rate", "leaves", "l2"), "native": ("depth", "rate", "l2")}[self.kind]
        return ", ".join(f"{n}={v}" for n, v in zip(names, self.grid[c]))


# The grids, sizes and names of the compared models, the calibration rule and the seeds.
LOGISTIC = Family("Logistic Regression", "logistic", ((0.05,), (0.2,), (1.0,), (5.0,)))
FOREST = Family("Random Forest", "forest", ((8, 2), (8, 5), (None, 2), (None, 5)), 300)
LEAFWISE = Family("Gradient Boosting", "leafwise", tuple((r, n, l2) for r in (0.03, 0.08) for n in (15, 31) for l2 in (0.0, 1.0)), 250)
NATIVE = Family("Native Categorical Boosting", "native", tuple((d, r, l2) for d in (4, 6) for r in (0.03, 0.08) for l2 in (3.0, 7.0)), 400)
PREVALENCE, SINGLE, BLEND = "Constant prevalence baseline", "Calibrated best single", "Calibrated OOF blend"
CALIBRATION_C, CLIP = 1.0, 1e-6
PR_AUC_TOLERANCE = 0.005
INNER_FOLDS, INNER_SEED = 4, 62
# End of fixed values.


#: Bytes of trees that the driver and a task hold at a time, before those of the next training sets are grown.
FOREST_BYTES = 128 << 20


# ---------------------------------------------------------------- features
def feature_columns(numeric: Sequence[str], categorical: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numbers and categories after the feature builder."""
    have = set(numeric) | set(categorical)
    numbers = [c for c in numeric if c != "pdays"] + [d for d, needs in DERIVED_SOURCES.items() if set(needs) <= have]
    return numbers, [*categorical, *(["previously_contacted"] if "pdays" in have else [])]


@dataclass(frozen=True)
class Prepared:
    df: DataFrame
    design: D.Design


def prepare(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: Sequence[str] = (), label: str = "label", id_col: str = "contact_id", levels=None) -> Prepared:
    """The built features of ``df`` (columns: id, label, folds, raw columns) and their blocks."""
    numbers, categories = feature_columns(numeric, categorical)
    built = FeatureBuilder().transform(df.select(id_col, label, *numeric, *categorical, *folds))
    return Prepared(built, D.encode(built, numbers, categories, label, id_col, folds, levels))


def fit_family(family: Family, ready: Prepared, fits: Sequence[D.Fit], learnt: Sequence[D.Learnt], label: str = "label", stay: bool = False):
    """All candidates on all training sets: (models, features); with ``stay`` boosted models may stay in the tasks that score with them."""
    d, n = ready.design, len(ready.design.numeric)
    if family.kind == "logistic":
        rows = L.unwritten(d, fits, learnt)
        return L.fit_logistic(rows, learnt, [c for (c,) in family.grid]), rows
    if family.kind == "native":
        rows = O.with_statistics(d, fits, learnt, T.binned_statistics)
        return T.fit_boosting(rows, learnt, n, [T.Candidate(r, l2, depth=depth, min_rows=0) for depth, r, l2 in family.grid], family.size, ordered=True, stay=stay), rows
    rows = D.features(d, fits, learnt, T.binned, "fold-bins")
    if family.kind == "leafwise":
        return T.fit_boosting(rows, learnt, n, [T.Candidate(r, l2, leaves=leaves) for r, leaves, l2 in family.grid], family.size, stay=stay), rows
    return T.fit_forest(rows, learnt, n, forest_leaves(family), family.size), rows


def forest_leaves(family: Family) -> tuple[int, ...]:
    return tuple(sorted({leaf for _, leaf in family.grid}))


def score_family(family: Family, models, rows: DataFrame) -> DataFrame:
    if family.kind == "logistic":
        return L.score_logistic(rows, models, len(family.grid))
    if family.kind == "forest":
        leaves = forest_leaves(family)
        return T.score_forest(rows, models, [(depth, leaves.index(leaf)) for depth, leaf in family.grid])
    return T.score_boosting(rows, models)


def narrowed(ready: Prepared, learnt: Sequence[D.Learnt], numeric: Sequence[str], categorical: Sequence[str]) -> tuple[Prepared, list[D.Learnt]]:
    """``prepare`` and ``learn`` for some of the raw columns, from those of more: a built feature depends on its own sources only."""
    design, some = D.narrowed(ready.design, learnt, *feature_columns(numeric, categorical))
    return Prepared(ready.df, design), some


def fold_scores(families: Sequence[Family], ready: Prepared, fits: Sequence[D.Fit], label: str = "label", learnt: Sequence[D.Learnt] | None = None) -> DataFrame:
    """(model, candidate, fit, id, label, p): every candidate on the rows that each training set left out; written once.  ``learnt``: of these training sets, if it is known."""
    learnt = D.learn(ready.design, ready.df, fits, label, T.BINS - 1) if learnt is None else learnt
    out = None
    for family in families:
        with described(ready.df.sparkSession, f"{family.name}: {len(family.grid)} candidates on {len(fits)} training sets", tag="callcast-fit"):
            for models, rows in fitted_in_turn(family, ready, fits, learnt, label):
                scored = score_family(family, models, rows).select(F.lit(family.name).alias("model"), "candidate", "fit", "id", "label", "p")
                with arrow_rows(ready.df.sparkSession, D.BATCH_BLOCKS):
                    scored = materialize(scored, "fold-scores")
                out = scored if out is None else out.unionByName(scored)
    return out


def fitted_in_turn(family: Family, ready: Prepared, fits: Sequence[D.Fit], learnt: Sequence[D.Learnt], label: str = "label"):
    """(models, features) of all candidates: of all training sets at once, or forests of as many as ``FOREST_BYTES`` hold; each forest is scored before the next is grown.

    A task that grows the trees of a whole training set scores with each of them, and holds one at a time.
    """
    if family.kind != "forest":
        yield fit_family(family, ready, fits, learnt, label, True)
        return
    held = 1 if T.fits_a_task(learnt, range(len(learnt))) else family.size
    rows = D.features(ready.design, fits, learnt, T.binned, "fold-bins")
    groups: list[list[int]] = []
    room = 0
    for k, s in enumerate(learnt):
        size = T.forest_bytes(s.counts.sum(), forest_leaves(family), held)
        if not groups or size > room:
            groups.append([])
            room = FOREST_BYTES
        groups[-1].append(k)
        room -= size
    for group in groups:
        part = rows.where(F.col("fit").isin(group)) if len(groups) > 1 else rows
        yield T.fit_forest(part, learnt, len(ready.design.numeric), forest_leaves(family), family.size, fits=group, stay=True), part


#: Scores that are ranked together; their tables are removed before the next ones are made.
RANKED_ROWS = 5_000_000


def fold_metrics(families: Sequence[Family], ready: Prepared, fits: Sequence[D.Fit], label: str = "label") -> list[tuple]:
    """(model, candidate, number of the training set, average precision): the ranking of ``fold_scores``, which are never all written."""
    spark = ready.df.sparkSession
    learnt = D.learn(ready.design, ready.df, fits, label, T.BINS - 1)
    n = ready.design.blocks.agg(F.sum("n")).first()[0] or 0
    out: list[tuple] = []
    for family in families:
        with described(spark, f"{family.name}: {len(family.grid)} candidates on {len(fits)} training sets", tag="callcast-fit"):
            for models, rows in fitted_in_turn(family, ready, fits, learnt, label):
                for some in _ranked_together(models, [(n - s.counts.sum()) * len(family.grid) for s in learnt]):
                    with disposable(spark), arrow_rows(spark, D.BATCH_BLOCKS):
                        ranked = EV.ranking_metrics_by(score_family(family, some, rows), ["candidate", "fit"])
                        out += [(family.name, r.candidate, r.fit, r.average_precision) for r in ranked.collect()]  # one row per candidate and training set
    return out


def _ranked_together(models, scores: Sequence[float]):
    """The models of a few training sets at a time, with at most ``RANKED_ROWS`` scores or of one training set."""
    if isinstance(models, T.InTasks):
        yield models
        return
    some, room = set(), 0.0
    for f in sorted({f for f, _ in models}):
        if some and scores[f] > room:
            yield {k: v for k, v in models.items() if k[0] in some}
            some = set()
        room = (room if some else RANKED_ROWS) - scores[f]
        some.add(f)
    yield {k: v for k, v in models.items() if k[0] in some}


def cross_validate(df: DataFrame, families: Sequence[Family], numeric, categorical, folds: Sequence[str], k: int = 5, label: str = "label") -> DataFrame:
    """(model, candidate, parameters, mean_score, std_score, folds) over all folds of all repeats, best first; the score is average precision."""
    fits = [D.Fit(f"{c}-{v}", ((i, v),)) for i, c in enumerate(folds) for v in range(k)]
    with disposable(df.sparkSession):
        per_fold = df.sparkSession.createDataFrame(fold_metrics(families, prepare(df, numeric, categorical, folds, label), fits, label), "model string, candidate int, fit int, average_precision double")
    names = [(f.name, c, f.label(c)) for f in families for c in range(len(f.grid))]
    labels = df.sparkSession.createDataFrame(names, "model string, candidate int, parameters string")
    summary = cv_summary(per_fold.withColumn("key", F.concat_ws("/", "model", "candidate")), "key", "average_precision")
    return labels.withColumn("key", F.concat_ws("/", "model", "candidate")).join(summary, "key").drop("key").orderBy(F.col("mean_score").desc(), "model", "candidate")


def best_candidates(summary: DataFrame, families: Sequence[Family]) -> list[Family]:
    """Every family with the candidate of the highest mean score only."""
    best: dict[str, int] = {}
    for r in summary.orderBy(F.col("mean_score").desc(), "candidate").collect():  # one row per candidate
        best.setdefault(r.model, r.candidate)
    return [Family(f.name, f.kind, (f.grid[best[f.name]],), f.size) for f in families]


# ---------------------------------------------------------------- calibration
def logits(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, CLIP, 1 - CLIP)
    return np.log(p / (1 - p))


def fit_calibrators(wide: DataFrame, names: Sequence[str], fits: Sequence[str | None], by: str | None = None) -> dict:
    """Logistic layers on the logits of the columns ``names``: one per value of ``by``, all fitted in the same jobs.

    ``wide``: id, label, one probability column per name.  Returns value -> coefficients (intercept first).
    """
    from callcast.learn.design import FEATURES, feature_row

    values = list(fits)
    at = {v: k for k, v in enumerate(values)}
    cols = wide.select("id", "label", F.array(*[F.col(f"`{n}`") for n in names]).alias("p"), (F.col(by) if by else F.lit(None).cast("string")).cast("string").alias("by"))

    def pack(batches):
        for b in batches:
            ids, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = logits(b.column(2).flatten().to_numpy().reshape(len(ids), -1))
            own = np.array([at.get(v, -1) for v in b.column(3).to_pylist()])
            for k in np.unique(own[own >= 0]):
                m = own == k
                n = int(m.sum())
                yield feature_row(int(k), "", ids[m], y[m].astype(float), np.ones(n, bool), np.ones(n, bool), np.concatenate([np.ones((n, 1)), x[m]], axis=1))

    rows = materialize(cols.mapInArrow(pack, FEATURES), "calibration-rows")
    plain = [D.Learnt(np.zeros(len(names)), np.ones(len(names)), [], [], [], np.ones(2)) for _ in values]
    got = L.fit_logistic(rows, plain, [CALIBRATION_C], balanced=False)
    return {v: got[(k, 0)] for k, v in enumerate(values)}


def calibrated(wide: DataFrame, names: Sequence[str], coef, out: str):
    """``wide`` with the calibrated probability; ``coef``: a column of coefficient arrays."""
    z = coef[0]
    for k, n in enumerate(names):
        p = F.least(F.greatest(F.col(f"`{n}`"), F.lit(CLIP)), F.lit(1 - CLIP))
        z = z + coef[k + 1] * F.log(p / (1 - p))
    return wide.withColumn(out, 1 / (1 + F.exp(-z)))


def _array_by(values: Mapping, key):
    """A column that picks the coefficients of a row's fold."""
    expr = None
    for v, w in values.items():
        lit = F.array(*[F.lit(float(x)) for x in w])
        expr = F.when(key == F.lit(v), lit) if expr is None else expr.when(key == F.lit(v), lit)
    return expr


@dataclass
class CrossFit:
    rows: DataFrame  # id, label, outer, one column per family, p_single, p_blend
    summary: DataFrame  # strategy, oof_pr_auc, oof_brier
    best_single: str
    single: np.ndarray
    blend: np.ndarray
    names: list[str]


def wide_scores(scores: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per key and label, one column per model: joined on the id by an aggregate, never by position."""
    picked = [F.max(F.when(F.col("model") == n, F.col("p"))).alias(n) for n in names]
    return scores.groupBy(*keys, "label").agg(*picked)


def cross_fit(
    df: DataFrame, families: Sequence[Family], best_single: str, numeric, categorical, outer: str, k: int = 5, label: str = "label", id_col: str = "contact_id",
    inner_k: int = INNER_FOLDS, inner_seed: int = INNER_SEED,
) -> CrossFit:
    """Outer and inner out-of-fold scores of every family in one pass over k + k * inner_k training sets, and both calibrations.

    The scores are written before anything is calibrated, so a driver that starts again reads them.
    """
    names = [f.name for f in families]
    inner = [f"inner_{o}" for o in range(k)]
    keyed = df
    for o in range(k):
        part = SP.kfold_assign(df.where(F.col(outer) != o).select(id_col, label), k=inner_k, seeds=(inner_seed + o,), label_col=label, id_col=id_col, prefix="_in")
        keyed = keyed.join(part.select(id_col, F.col(f"_in_{inner_seed + o}").alias(inner[o])), id_col, "left")
    keyed = materialize(keyed, "nested-folds")
    ready = prepare(keyed, numeric, categorical, [outer, *inner], label, id_col)
    fits = [D.Fit(f"{o}", ((0, o),)) for o in range(k)] + [D.Fit(f"{o}/{i}", ((0, o), (1 + o, i))) for o in range(k) for i in range(inner_k)]
    scores = fold_scores(families, ready, fits, label)
    outer_of = F.when(F.col("fit") < k, F.col("fit")).otherwise(F.floor((F.col("fit") - k) / inner_k)).cast("int")
    scores = scores.withColumns({"outer": outer_of, "level": F.when(F.col("fit") < k, 0).otherwise(1)})
    top = materialize(wide_scores(scores.where("level = 0"), names, ["id", "outer"]), "outer-scores")
    below = materialize(wide_scores(scores.where("level = 1"), names, ["id", "outer"]), "inner-scores")
    _complete(top, df, id_col, names, 1)
    _complete(below, df, id_col, names, k - 1)
    outers = [str(o) for o in range(k)]
    rows = top
    for out, cols in (("p_single", [best_single]), ("p_blend", names)):
        coef = fit_calibrators(below, cols, outers, "outer")
        rows = calibrated(rows, cols, _array_by({int(o): w for o, w in coef.items()}, F.col("outer")), out)
    rows = materialize(rows, "calibrated")
    single = fit_calibrators(top, [best_single], [None])[None]
    blend = fit_calibrators(top, names, [None])[None]
    return CrossFit(rows, strategy_summary(rows, names), best_single, single, blend, names)


def _complete(wide: DataFrame, df: DataFrame, id_col: str, names: Sequence[str], times: int) -> None:
    """Every row of ``df`` is scored by every model, exactly ``times`` times."""
    missing = F.sum(F.when(F.greatest(*[F.col(f"`{n}`").isNull().cast("int") for n in names], F.lit(0)) > 0, 1).otherwise(0))
    per = wide.groupBy("id").agg(F.count(F.lit(1)).alias("n"), missing.alias("m"))
    got = per.agg(F.count(F.lit(1)).alias("ids"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("m").alias("m")).first()
    if got.ids != df.select(id_col).distinct().count() or got.lo != times or got.hi != times or got.m:
        raise RuntimeError("out-of-fold scores must cover every row once per training set")


def strategy_summary(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(strategy, oof_pr_auc, oof_brier) of the prevalence, every raw model and both calibrations."""
    prevalence = rows.agg(F.avg("label")).first()[0]
    shown = [(PREVALENCE, F.lit(float(prevalence or 0.0))), *((f"Raw {n}", F.col(f"`{n}`")) for n in names), (SINGLE, F.col("p_single")), (BLEND, F.col("p_blend"))]
    long = rows.select("label", F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), p.alias("p")) for s, p in shown])).alias("x")).select("label", "x.*")
    brier = long.groupBy("strategy").agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("oof_brier"))
    return EV.ranking_metrics_by(long, ["strategy"]).join(brier, "strategy").select("strategy", F.col("average_precision").alias("oof_pr_auc"), "oof_brier")


def choose(summary: DataFrame, tolerance: float = PR_AUC_TOLERANCE) -> DataFrame:
    """Of the calibrated strategies within ``tolerance`` of the best average precision the one with the lowest Brier score."""
    cal = summary.where(F.col("strategy").isin(SINGLE, BLEND))
    best = cal.agg(F.max("oof_pr_auc")).first()[0]
    return cal.where(F.col("oof_pr_auc") >= F.lit(best - tolerance)).orderBy("oof_brier", F.col("oof_pr_auc").desc(), "strategy").limit(1)


# ---------------------------------------------------------------- one model of it all
@dataclass
class Base:
    """A fitted base model: what its preprocessing learnt, its parameters, and level totals for ordered statistics."""

    family: Family
    learnt: D.Learnt
    params: object  # coefficients, or a list of trees as arrays
    totals: np.ndarray | None = None
    max_depth: int | None = None

    def probability(self, num: np.ndarray, cat: np.ndarray) -> np.ndarray:
        num, codes = D.filled(num, cat, self.learnt)
        if self.family.kind == "logistic":
            return 1 / (1 + np.exp(-np.clip(L.dense(num, codes, self.learnt) @ self.params, -500, 500)))
        if self.family.kind == "native":
            bins = T.binned_statistics(num, codes, O.statistics_of_new(codes, self.totals, self.learnt), self.learnt)
        else:
            bins = T.binned(num, codes, self.learnt)
        total = sum(t[5][T.route(t, bins, self.max_depth)] for t in self.params)
        return np.clip(total / len(self.params), 0.0, 1.0) if self.family.kind == "forest" else 1 / (1 + np.exp(-total))


def _array_bytes(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, np.asarray(a), allow_pickle=False)
    return out.getvalue()


def _of_bytes(b: bytes) -> np.ndarray:
    return np.load(io.BytesIO(bytes(b)), allow_pickle=False)


class StrategyModel(Model, MLWritable, MLReadable):
    """Base models, a logistic layer on their logits, and a threshold.

    ``transform`` adds ``probability_<model>`` for each base model, ``subscription_probability`` and
    ``prediction``; it needs the raw columns only, is narrow, and keeps every row (a null number counts
    as the training median, a null or unseen level as the preprocessing says).
    """

    def __init__(self, bases: Sequence[Base] = (), calibrator: np.ndarray | None = None, threshold: float = 0.5, strategy: str = SINGLE, columns: Mapping | None = None):
        super().__init__()
        self.bases, self.threshold, self.strategy = list(bases), float(threshold), strategy
        self.calibrator = np.zeros(1) if calibrator is None else np.asarray(calibrator, dtype=float)
        self.columns = dict(columns or {})  # numeric, categorical (raw), levels
        self._sent: tuple | None = None

    def _broadcast(self, spark):
        """The base models, calibrator and level codes, sent once per session however often the model scores."""
        sc = spark.sparkContext
        if self._sent is None or self._sent[0] != sc.applicationId:
            self._sent = sc.applicationId, sc.broadcast((self.bases, self.calibrator, [{v: i for i, v in enumerate(x)} for x in self.columns["levels"]]))
        return self._sent[1]

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        numeric, categorical = self.columns["numeric"], self.columns["categorical"]
        numbers, categories = feature_columns(numeric, categorical)
        sent = self._broadcast(df.sparkSession)

        def run(num: pd.Series, cat: pd.Series) -> pd.DataFrame:
            bases, w, codes = sent.value
            x = np.array([[np.nan if v is None else v for v in r] for r in num], dtype=float).reshape(len(num), -1)
            c = np.array([[m.get(v, -1) for m, v in zip(codes, r)] for r in cat], dtype=np.int64).reshape(len(cat), -1)
            p = [b.probability(x, c) for b in bases]
            z = w[0] + sum(a * logits(q) for a, q in zip(w[1:], p))
            return pd.DataFrame({**{f"p{i}": q for i, q in enumerate(p)}, "p": 1 / (1 + np.exp(-z))})

        schema = ", ".join(f"p{i} double" for i in range(len(self.bases))) + ", p double"
        score = F.pandas_udf(run, schema)
        raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        built = FeatureBuilder().transform(df.select(raw.alias("_row"), *[F.col(f"`{c}`") for c in dict.fromkeys([*numeric, *categorical])]))
        num = F.array(*[F.col(c).cast("double") for c in numbers])
        cat = F.array(*[F.col(c).cast("string") for c in categories])
        scored = built.select("_row", score(num, cat).alias("_s"))
        new = {f"probability_{b.family.name.lower().replace(' ', '_')}": F.col(f"_s.p{i}") for i, b in enumerate(self.bases)}
        new |= {"subscription_probability": F.col("_s.p"), "prediction": (F.col("_s.p") >= F.lit(self.threshold)).cast("int")}
        kept = [c for c in df.columns if c not in new]
        return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *[v.alias(k) for k, v in new.items()])

    def write(self) -> "StrategyWriter":
        return StrategyWriter(self)

    @classmethod
    def read(cls) -> "StrategyReader":
        return StrategyReader()

    def metadata(self) -> dict:
        return {
            "strategy": self.strategy, "threshold": self.threshold, "calibrator": self.calibrator.tolist(), "columns": self.columns,
            "bases": [{"name": b.family.name, "kind": b.family.kind, "grid": b.family.grid, "size": b.family.size, "max_depth": b.max_depth} for b in self.bases],
            "prediction_point": "before the call", "excluded_features": ["duration"],
        }


_STATE = "base int, part string, place int, data binary"
#: Bytes of arrays that are written at a time.
SAVED_BYTES = 8 << 20


class StrategyWriter(MLWriter):
    """Metadata as one JSON row; arrays one row each (a tree is a few rows), written by Spark to any store it can write."""

    def __init__(self, model: StrategyModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        m = self.model
        rows = []
        for i, b in enumerate(m.bases):
            s = b.learnt
            single = {"median": s.median, "scale": s.scale, "mode": np.array(s.mode, dtype=np.int64), "counts": s.counts, "weights": s.weights}
            if b.totals is not None:
                single["totals"] = b.totals
            if b.family.kind == "logistic":
                single["coef"] = b.params
            rows += [(i, k, 0, v) for k, v in single.items()]
            rows += [(i, k, j, v) for k, vs in (("edges", s.edges), ("known", s.known)) for j, v in enumerate(vs)]
            if b.family.kind != "logistic":
                rows += [(i, f"tree{c}", j, a) for j, t in enumerate(b.params) for c, a in enumerate(t)]
        spark.createDataFrame([(json.dumps(m.metadata(), sort_keys=True), m.uid)], "metadata string, uid string").coalesce(1).write.json(f"{path}/metadata")
        held, size = [], 0
        for k, (base, part, place, array) in enumerate(rows):
            held.append((base, part, place, _array_bytes(array)))
            size += len(held[-1][3])
            if size >= SAVED_BYTES or k + 1 == len(rows):
                spark.createDataFrame(held, _STATE).coalesce(1).write.mode("append").parquet(f"{path}/state")
                held, size = [], 0


class StrategyReader(MLReader):
    def load(self, path: str) -> StrategyModel:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        head = spark.read.json(f"{path}/metadata").first()
        meta = json.loads(head["metadata"])
        state: dict = {}
        for r in spark.read.parquet(f"{path}/state").toLocalIterator():  # the model itself
            state.setdefault(r.base, {}).setdefault(r.part, {})[r.place] = _of_bytes(r.data)
        bases = []
        for i, b in enumerate(meta["bases"]):
            got = state[i]
            ordered = lambda k: [got[k][j] for j in sorted(got.get(k, {}))]  # noqa: E731, B023
            learnt = D.Learnt(got["median"][0], got["scale"][0], ordered("edges"), got["mode"][0].tolist(), ordered("known"), got["counts"][0], got["weights"][0])
            family = Family(b["name"], b["kind"], tuple(tuple(g) for g in b["grid"]), b["size"])
            params = got["coef"][0] if b["kind"] == "logistic" else list(zip(*(ordered(f"tree{c}") for c in range(7))))
            bases.append(Base(family, learnt, params, got["totals"][0] if "totals" in got else None, b["max_depth"]))
        model = StrategyModel(bases, np.array(meta["calibrator"]), meta["threshold"], meta["strategy"], meta["columns"])
        model._resetUid(head["uid"])
        return model


def fit_strategy(df: DataFrame, families: Sequence[Family], calibrator: np.ndarray, threshold: float, strategy: str, numeric, categorical, label: str = "label") -> StrategyModel:
    """The base models on all rows of ``df``, with a calibrator and threshold that out-of-fold rows have fixed; a family's first candidate counts."""
    ready = prepare(df, numeric, categorical, (), label)
    fits = [D.Fit("all")]
    learnt = D.learn(ready.design, ready.df, fits, label, T.BINS - 1)
    bases = []
    for family in families:
        family = Family(family.name, family.kind, family.grid[:1], family.size)
        models, _ = fit_family(family, ready, fits, learnt, label)
        params = models[(0, 0)] if family.kind == "logistic" else [t.arrays() for t in models[(0, 0)]]
        totals = O.level_totals(ready.design, fits, learnt)[0] if family.kind == "native" else None
        bases.append(Base(family, learnt[0], params, totals, family.grid[0][0] if family.kind == "forest" else None))
    columns = {"numeric": list(numeric), "categorical": list(categorical), "levels": [list(v) for v in ready.design.levels]}
    return StrategyModel(bases, calibrator, threshold, strategy, columns)


def freeze(fit: CrossFit, df: DataFrame, families: Sequence[Family], numeric, categorical, label: str = "label") -> StrategyModel:
    """The chosen strategy: its threshold has the highest F1 of the out-of-fold rows, its base models learn from all rows of ``df``."""
    chosen = choose(fit.summary).first()["strategy"]
    column, names, coef = ("p_blend", fit.names, fit.blend) if chosen == BLEND else ("p_single", [fit.best_single], fit.single)
    threshold = EV.best_f1_threshold(fit.rows.select("label", F.col(column).alias("p"))).first()["threshold"]
    used = [f for n in names for f in families if f.name == n]
    return fit_strategy(df, used, coef, threshold, chosen, numeric, categorical, label)


# ---------------------------------------------------------------- what the frozen model is worth
def permutation_importance(model: Model, test: DataFrame, features: Sequence[str], repeats: int = 10, top: int = 12, seed: int = 42, label: str = "label", id_col: str = "contact_id", side_by_side: int = 4) -> DataFrame:
    """Drop in average precision when one raw column is permuted: mean and population standard deviation over the repeats."""
    from callcast.operators.permute import permuted, ranked

    rows, n = ranked(test, id_col)
    p = F.col("subscription_probability").alias("p")
    base = EV.ranking_metrics(model.transform(rows).select("label", p)).first()["average_precision"]

    def one(f: str) -> DataFrame:  # a frame of n * repeats rows
        with described(rows.sparkSession, f"importance of {f}"):
            scored = model.transform(permuted(rows, n, f, repeats, seed)).select(F.lit(f).alias("feature"), "perm_repeat", F.col(label).alias("label"), p)
            return materialize(EV.ranking_metrics_by(scored, ["feature", "perm_repeat"]), "importance")

    with ThreadPoolExecutor(max_workers=side_by_side) as pool:  # a few columns' jobs at a time
        parts = list(pool.map(one, features))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    drop = F.lit(base) - F.col("average_precision")
    return out.groupBy("feature").agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std")).orderBy(F.col("importance_mean").desc(), "feature").limit(top)


def held_out(scored: DataFrame, threshold: float, prevalence: float, label: str = "label", p: str = "subscription_probability") -> DataFrame:
    """One row: ranking, threshold and Brier metrics of frozen scores against rows that nothing was learnt from.

    ``prevalence`` is the share of positives among the rows that were learnt from: the Brier baseline.
    """
    rows = scored.select(F.col(label).cast("double").alias("label"), F.col(p).alias("p"))
    ranking = EV.ranking_metrics(rows)
    cut = EV.threshold_metrics(rows, threshold)
    brier = rows.agg(F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("b"), F.avg(F.pow(F.lit(float(prevalence)) - F.col("label"), 2)).alias("c"))
    brier = brier.select(F.round("b", 10).alias("brier"), F.round("c", 10).alias("brier_baseline"), F.round(1 - F.col("b") / F.col("c"), 10).alias("brier_skill"))
    keyed = [f.withColumn("_k", F.lit(1)) for f in (ranking, cut, brier)]  # one row each
    return keyed[0].join(keyed[1], "_k").join(keyed[2], "_k").drop("_k")


def round_trip(model: StrategyModel, test: DataFrame, path: str, id_col: str = "contact_id") -> DataFrame:
    """Save, load again, and compare every row's probability and prediction by id, and all metadata: (check, passed, detail)."""
    model.write().overwrite().save(path)
    again = StrategyModel.load(path)
    cols = lambda m, t: m.transform(test).select(id_col, F.col("subscription_probability").alias(f"p{t}"), F.col("prediction").alias(f"y{t}"))
    both = cols(model, 1).join(cols(again, 2), id_col, "full_outer")
    d = both.agg(F.max(F.abs(F.col("p1") - F.col("p2"))).alias("d"), F.sum((~F.col("p1").eqNullSafe(F.col("p2")) | ~F.col("y1").eqNullSafe(F.col("y2"))).cast("long")).alias("bad"), F.count(F.lit(1)).alias("rows"))
    text = lambda m: json.dumps(m.metadata(), sort_keys=True)
    same = text(again) == text(model) and again.uid == model.uid
    checks = F.array(
        F.struct(F.lit("predictions_equal").alias("check"), (F.coalesce(F.col("bad"), F.lit(0)) == 0).alias("passed"), F.concat(F.lit("rows="), F.col("rows").cast("string"), F.lit(" max_abs_diff="), F.coalesce(F.col("d"), F.lit(0.0)).cast("string")).alias("detail")),
        F.struct(F.lit("metadata_equal").alias("check"), F.lit(same).alias("passed"), F.lit(f"strategy={model.strategy} models={len(model.bases)}").alias("detail")),
    )
    return d.select(F.explode(checks).alias("c")).select("c.*")
