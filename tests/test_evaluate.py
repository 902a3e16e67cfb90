"""FIXTURES.md section 3: the 10-row score fixture and the areaUnderPR contrast case."""

import pytest

from callcast.operators import evaluate as EV

SCORED_SMALL = [(1, .9), (0, .8), (1, .8), (1, .6), (0, .5), (0, .4), (1, .3), (0, .3), (0, .2), (0, .1)]


@pytest.fixture(scope="module")
def scored_small(spark):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(SCORED_SMALL, 1)], "contact_id long, label int, p double")


def test_ranking(scored_small):
    r = EV.ranking_metrics(scored_small).first()
    assert r.average_precision == pytest.approx(0.7291666667, abs=1e-9)
    assert r.roc_auc == pytest.approx(0.7916666667, abs=1e-9)


def test_pr_curve_table(scored_small):
    got = {r.threshold: (r.tp, r.fp, round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) for r in EV.pr_curve(scored_small).collect()}
    assert got == {
        .9: (1, 0, 1.0, .25, .4), .8: (2, 1, .6667, .5, .5714), .6: (3, 1, .75, .75, .75), .5: (3, 2, .6, .75, .6667),
        .4: (3, 3, .5, .75, .6), .3: (4, 4, .5, 1.0, .6667), .2: (4, 5, .4444, 1.0, .6154), .1: (4, 6, .4, 1.0, .5714),
    }


def test_best_threshold_and_table(scored_small):
    assert EV.best_f1_threshold(scored_small).first().threshold == 0.6
    rows = {r.threshold: r for r in EV.threshold_table(scored_small).collect()}
    assert sorted(rows) == [0.1, 0.2, 0.5, 0.6]
    assert rows[0.6].selected and not rows[0.5].selected


def test_brier(scored_small):
    r = EV.brier(scored_small, base_rate=0.4).first()
    assert r.brier == pytest.approx(0.189, abs=1e-12)
    assert r.brier_baseline == pytest.approx(0.24, abs=1e-12)


def test_contrast_with_spark_area_under_pr(spark):
    df = spark.createDataFrame([(1, .9), (0, .8), (1, .7), (0, .6), (0, .2)], "label int, p double")
    r = EV.ranking_metrics(df).first()
    assert r.average_precision == pytest.approx(0.8333333333, abs=1e-9)
    assert r.roc_auc == pytest.approx(0.8333333333, abs=1e-9)


def test_lift(scored_small):
    rows = {r.contact_share: r for r in EV.lift_table(scored_small).collect()}
    assert rows[0.1].customers_contacted == 1 and rows[0.1].subscription_rate == 1.0
    # top 2 by (p desc, id): ids 1 and 2 -> one positive of four
    assert rows[0.2].subscriber_capture_rate == 0.25
    assert rows[0.3].customers_contacted == 3


def test_classification_report(scored_small):
    rows = {r["class"]: r for r in EV.classification_report(scored_small, 0.6).collect()}
    assert rows["1"].precision == pytest.approx(0.75) and rows["1"].recall == pytest.approx(0.75)
    assert rows["1"].support == 4 and rows["0"].support == 6
    assert rows["accuracy"].f1 == pytest.approx(0.8)
