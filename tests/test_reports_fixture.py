"""Golden values of FIXTURES.md section 2 on the 12-row hand fixture."""

import pytest

from callcast.operators import reports as R
from callcast.operators import stats as ST


def as_dict(df, key, *vals):
    return {r[key]: tuple(r[v] for v in vals) for r in df.collect()}


def test_avg_balance_by_job(small):
    got = as_dict(R.avg_balance_by_job(small), "job", "avg_balance", "clients")
    assert got == {
        "blue-collar": (-70.0, 2), "management": (1850.0, 2), "retired": (2933.33, 3), "services": (300.0, 2),
        "student": (500.0, 1), "technician": (0.0, 1), "unknown": (750.0, 1),
    }


def test_contacts_by_month_y(small):
    got = {(r.month, r.y): r.clients for r in R.contacts_by_month_y(small).collect()}
    assert got == {("aug", "no"): 1, ("dec", "no"): 1, ("jan", "no"): 1, ("jul", "yes"): 1, ("jun", "no"): 1,
                   ("mar", "yes"): 1, ("may", "no"): 3, ("may", "yes"): 1, ("oct", "yes"): 2}


def test_housing_by_education(small):
    got = {(r.education, r.housing): r.clients for r in R.housing_by_education(small).collect()}
    assert got == {("primary", "no"): 2, ("primary", "yes"): 2, ("secondary", "no"): 2, ("secondary", "yes"): 2,
                   ("tertiary", "no"): 1, ("tertiary", "yes"): 1, ("unknown", "no"): 1, ("unknown", "yes"): 1}


def test_avg_duration_by_poutcome(small):
    got = as_dict(R.avg_duration_by_poutcome(small), "poutcome", "avg_duration", "clients")
    assert got == {"failure": (400.0, 1), "other": (520.0, 1), "success": (410.0, 2), "unknown": (136.25, 8)}


def test_age_balance_summary(small):
    got = as_dict(R.age_balance_summary(small), "age_band", "avg_balance", "clients")
    assert got == {"18-29": (150.0, 2), "30-39": (1083.33, 3), "40-49": (353.33, 3), "50-59": (1950.0, 2),
                   "60+": (2850.0, 2)}


def test_avg_balance_by_age_group(small):
    got = as_dict(R.avg_balance_by_age_group(small), "age_group", "avg_balance")
    assert got == {"<30": (150.0,), "30-60": (1078.89,), ">60": (4200.0,)}


def test_corr(small):
    assert ST.corr(small).first()[0] == pytest.approx(0.5849098904, abs=1e-9)


def test_balance_anomalies_empty(small):
    assert R.balance_anomalies(small).count() == 0


def test_crosstab(small):
    got = {(r.contact, r.y): r["count"] for r in R.crosstab(small, "contact", "y").collect()}
    assert got == {("cellular", "no"): 1, ("cellular", "yes"): 5, ("telephone", "no"): 2, ("telephone", "yes"): 0,
                   ("unknown", "no"): 4, ("unknown", "yes"): 0}


def test_chi_square(small):
    r = ST.chi_square(small, "contact", "y").first()
    assert r.chi2 == pytest.approx(8.5714285714, abs=1e-9)
    assert r.dof == 2
    assert r.p_value == pytest.approx(0.0137637867, abs=1e-9)
    assert r.cramers_v == pytest.approx(0.8451542547, abs=1e-9)


def test_mann_whitney_balance(small):
    r = ST.mann_whitney(small, "balance").first()
    assert r.u_statistic == 30.0
    assert r.rank_biserial == pytest.approx(0.7142857143, abs=1e-9)
    assert r.z == pytest.approx(1.9487950631, abs=1e-9)
    assert r.p_value == pytest.approx(0.0513199036, abs=1e-9)


def test_mann_whitney_campaign_ties(small):
    r = ST.mann_whitney(small, "campaign").first()
    assert r.u_statistic == 1.0
    assert r.rank_biserial == pytest.approx(-0.9428571429, abs=1e-9)
    assert abs(r.z) == pytest.approx(2.6693362143, abs=1e-9)
    assert r.p_value == pytest.approx(0.0076001330, abs=1e-9)


def test_unknown_profile(small):
    got = as_dict(R.unknown_profile(small), "column_name", "unknown_count")
    assert got == {"poutcome": (8,), "contact": (4,), "education": (2,), "job": (1,)}


def test_group_rates_lists_empty_bins(small):
    rows = {(r.field, r.grp): (r.customers, r.subscription_rate) for r in R.group_rates(small).collect()}
    assert rows[("campaign_group", "11+")] == (1, 0.0)
    assert rows[("age_group", "60+")][0] == 2  # ages 60 and 61 fall in (59, 100]
    assert ("job", "unknown") in rows


def test_corr_matrix_both_paths(small):
    from pyspark.sql import functions as F

    full = {(r.a, r.b): r.corr for r in ST.corr_matrix(small).collect()}
    assert full[("age", "balance")] == pytest.approx(0.5849098904, abs=1e-9)
    assert full[("balance", "age")] == full[("age", "balance")] and full[("age", "age")] == 1.0
    # a NULL switches to the pairwise-complete aggregate; other pairs are unchanged
    with_null = small.withColumn("day", F.when(F.col("contact_id") == 1, None).otherwise(F.col("day")))
    part = {(r.a, r.b): r.corr for r in ST.corr_matrix(with_null).collect()}
    assert part[("age", "balance")] == pytest.approx(full[("age", "balance")], abs=1e-9)
