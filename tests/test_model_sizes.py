"""Registered model keys have the full sizes and grids; their steps on a small table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from callcast.learn import strategy as S
from callcast.plans import strategy_queries as Q
from callcast.plans.queries import QUERIES


def test_registered_families_have_full_sizes_and_grids():
    assert (len(S.LOGISTIC.grid), len(S.FOREST.grid), len(S.LEAFWISE.grid), len(S.NATIVE.grid)) == (4, 4, 8, 8)
    assert (S.FOREST.size, S.LEAFWISE.size, S.NATIVE.size) == (300, 250, 400) == (Q.FOREST.size, Q.LEAFWISE.size, Q.NATIVE.size)
    assert Q.REPEATS == ["fold_43", "fold_44"]
    for small, whole in ((Q.LOGISTIC, S.LOGISTIC), (Q.FOREST, S.FOREST), (Q.LEAFWISE, S.LEAFWISE), (Q.NATIVE, S.NATIVE)):
        assert small.grid[0] in whole.grid
    assert {"model_selection", "model_comparison", "model_zoo", "calibration_summary", "heldout_strategy", "artifact_roundtrip"} <= set(QUERIES)


FAMILIES = [S.Family("Logistic Regression", "logistic", ((0.2,),)), S.Family("Random Forest", "forest", ((4, 2), (None, 5)), 12), S.Family("Native Categorical Boosting", "native", ((3, 0.2, 3.0),), 6)]
NUM, CAT = ["age", "balance", "campaign", "pdays", "previous", "day"], ["job", "contact", "month", "poutcome"]


@pytest.fixture(scope="module")
def people(spark):
    r = np.random.default_rng(1)
    n = 700
    job, contact = r.choice(["a", "b", "c"], n), r.choice(["cellular", "unknown"], n)
    pout, month = r.choice(["success", "failure", "unknown"], n), r.choice(["jan", "may", "dec"], n)
    x = r.normal(size=n)
    y = r.random(n) < 1 / (1 + np.exp(-(1.2 * x + 1.5 * (pout == "success") - 1)))
    rows = [(i, float(y[i]), 30 + int(i % 40), float(100 * x[i]) if i % 31 else None, 1 + i % 5, -1 if i % 3 else i, i % 4, 1 + i % 28, str(job[i]), str(contact[i]), str(month[i]), str(pout[i]) if i % 29 else None, i % 5) for i in range(n)]
    return spark.createDataFrame(rows, "contact_id long, label double, age int, balance double, campaign int, pdays int, previous int, day int, job string, contact string, month string, poutcome string, fold int")


@pytest.fixture(scope="module")
def crossed(people):
    one = [S.Family(f.name, f.kind, f.grid[-1:], f.size) for f in FAMILIES]
    return S.cross_fit(people, one, "Random Forest", NUM, CAT, "fold"), one


def test_nested_scores_cover_every_row_and_calibrate(people, crossed):
    fit, families = crossed
    rows = fit.rows.collect()
    assert len(rows) == 700 and {r.id for r in rows} == set(range(700))
    assert all(0 < r.p_single < 1 and 0 < r.p_blend < 1 for r in rows)
    got = {r.strategy: r for r in fit.summary.collect()}
    assert set(got) == {S.PREVALENCE, S.SINGLE, S.BLEND, *(f"Raw {f.name}" for f in families)}
    assert got[S.BLEND].oof_brier < got[S.PREVALENCE].oof_brier and got[S.BLEND].oof_pr_auc > got[S.PREVALENCE].oof_pr_auc + 0.1
    # The single strategy of an outer fold is a logistic layer on the forest's logits, learnt without that fold.
    for o in range(5):
        p = np.array([[r["Random Forest"], r.p_single] for r in rows if r.outer == o])
        a, b = np.polyfit(S.logits(p[:, 0]), S.logits(p[:, 1]), 1)
        assert np.allclose(a * S.logits(p[:, 0]) + b, S.logits(p[:, 1]), atol=1e-6) and a > 0
    assert S.choose(fit.summary).first().strategy in (S.SINGLE, S.BLEND)


def test_calibrators_are_ridge_optima(spark):
    r = np.random.default_rng(2)
    p = r.uniform(0.02, 0.98, (400, 2))
    y = (r.random(400) < p[:, 0]).astype(float)
    wide = spark.createDataFrame([(i, float(y[i]), float(p[i, 0]), float(p[i, 1]), str(i % 2)) for i in range(400)], "id long, label double, a double, b double, g string")
    got = S.fit_calibrators(wide, ["a", "b"], ["0", "1"], "g")
    for g in (0, 1):
        m = np.arange(400) % 2 == g
        x = np.concatenate([np.ones((m.sum(), 1)), S.logits(p[m])], axis=1)
        q = 1 / (1 + np.exp(-x @ got[str(g)]))
        assert np.abs(x.T @ (q - y[m]) + np.concatenate([[0], got[str(g)][1:]])).max() < 1e-6


def test_saved_strategy_scores_every_row_alike(spark, people, crossed, tmp_path):
    fit, families = crossed
    model = S.freeze(fit, people, families, NUM, CAT)
    assert {r.check: r.passed for r in S.round_trip(model, people, str(tmp_path / "m")).collect()} == {"predictions_equal": True, "metadata_equal": True}
    again = S.StrategyModel.load(str(tmp_path / "m"))
    odd = people.limit(20).withColumns({"job": F.lit("never seen"), "balance": F.lit(None).cast("double"), "prediction": F.lit("old")})
    rows = again.transform(odd).collect()
    assert len(rows) == 20 and all(0 < r.subscription_probability < 1 and r.prediction == int(r.subscription_probability >= again.threshold) for r in rows)
    both = S.fit_strategy(people, families, fit.blend, 0.3, S.BLEND, NUM, CAT)
    scored = both.transform(people).select("contact_id", *[f"probability_{f.name.lower().replace(' ', '_')}" for f in families], "subscription_probability").collect()
    z = fit.blend[0] + sum(w * S.logits(np.array([r[1 + k] for r in scored])) for k, w in enumerate(fit.blend[1:]))
    assert np.allclose(1 / (1 + np.exp(-z)), [r.subscription_probability for r in scored])


def test_new_rows_are_scored_like_the_training_features(people):
    """A base model inside the strategy gives the probabilities of the block-wise scoring."""
    from callcast.learn import design as D

    for family in FAMILIES:
        family = S.Family(family.name, family.kind, family.grid[-1:], family.size)
        both = people.withColumn("part", (F.col("contact_id") % 4 == 0).cast("int"))
        ready = S.prepare(both, NUM, CAT, ["part"])
        want = {r.id: r.p for r in S.fold_scores([family], ready, [D.Fit("t", ((0, 1),))]).collect()}
        model = S.fit_strategy(both.where("part = 0").drop("part"), [family], np.array([0.0, 1.0]), 0.5, S.SINGLE, NUM, CAT)
        got = {r.contact_id: r.subscription_probability for r in model.transform(both.where("part = 1")).collect()}
        assert set(got) == set(want)
        assert np.mean(np.isclose([got[i] for i in want], np.clip([want[i] for i in want], 1e-6, 1 - 1e-6), atol=1e-6)) > 0.99


def test_importance_finds_the_column_that_counts(people, crossed):
    fit, families = crossed
    model = S.fit_strategy(people, families[:1], np.array([0.0, 1.0]), 0.5, S.SINGLE, NUM, CAT)
    got = S.permutation_importance(model, people, ["balance", "poutcome", "job", "campaign"], repeats=3).collect()
    assert [r.feature for r in got][:2] == ["balance", "poutcome"] and got[0].importance_mean > 0.1 > abs(got[-1].importance_mean)


def test_a_model_is_sent_once_and_saved_in_parts(spark, people, tmp_path, monkeypatch):
    family = S.Family("Random Forest", "forest", ((None, 5),), 6)
    model = S.fit_strategy(people, [family], np.array([0.0, 1.0]), 0.5, S.SINGLE, NUM, CAT)
    sent, made = [], []
    broadcast, frame = type(spark.sparkContext).broadcast, type(spark).createDataFrame
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: (sent.append(1), broadcast(self, value))[1])
    first, second = (model.transform(people).select("contact_id", "subscription_probability") for _ in range(2))
    assert len(sent) == 1 and sorted(first.collect()) == sorted(second.collect())
    monkeypatch.setattr(S, "SAVED_BYTES", 2000)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: (made.append(sum(len(r[3]) for r in data if len(r) == 4)), frame(self, data, *a, **k))[1])
    assert all(r.passed for r in S.round_trip(model, people, str(tmp_path / "m")).collect())
    assert len(made) > 5 and max(made) < 2000 + 8 * 800 + 200  # the limit and at most one array more


def test_fewer_columns_are_those_prepared_and_learnt_alone(people):
    from callcast.learn import design as D
    from callcast.learn import trees as T

    fits = [D.Fit(str(v), ((0, v),)) for v in range(2)]
    whole = S.prepare(people, NUM, CAT, ["fold"])
    learnt = D.learn(whole.design, whole.df, fits, bins=T.BINS - 1)
    for removed in (("poutcome", "pdays", "previous"), ("contact",), ("age",)):
        num, cat = [c for c in NUM if c not in removed], [c for c in CAT if c not in removed]
        alone = S.prepare(people, num, cat, ["fold"])
        want = D.learn(alone.design, alone.df, fits, bins=T.BINS - 1)
        some, got = S.narrowed(whole, learnt, num, cat)
        assert (some.design.numeric, some.design.categorical, some.design.levels) == (alone.design.numeric, alone.design.categorical, alone.design.levels)
        rows = [sorted((bytes(r.ids), bytes(r.y), bytes(r.num), bytes(r.cat), bytes(r.folds)) for r in x.design.blocks.collect()) for x in (some, alone)]
        assert rows[0] == rows[1]
        for a, b in zip(got, want, strict=True):
            assert a.mode == b.mode and all(np.array_equal(x, y) for x, y in zip([a.median, a.scale, *a.edges, *a.known], [b.median, b.scale, *b.edges, *b.known], strict=True))
