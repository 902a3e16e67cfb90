"""Named queries: key -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query reads the driver tables (through the derived ``contacts`` table)
in full.  ``ORACLE`` holds, per key, an independent DuckDB statement over the
same Parquet tables; keys without an exact SQL form are absent there.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from callcast.oracle import with_contacts as W
from callcast.operators import reports as R
from callcast.sources.contacts import contacts
from callcast.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def on_contacts(key: str, report, sql: str | None = None, **kw) -> None:
    register(key, sql)(lambda spark, sf: report(contacts(spark, sf), **kw))


YES = "CASE WHEN y = 'yes' THEN 1 ELSE 0 END"
MONTH_NUM = (
    "CASE month WHEN 'jan' THEN 1 WHEN 'feb' THEN 2 WHEN 'mar' THEN 3 WHEN 'apr' THEN 4 WHEN 'may' THEN 5 "
    "WHEN 'jun' THEN 6 WHEN 'jul' THEN 7 WHEN 'aug' THEN 8 WHEN 'sep' THEN 9 WHEN 'oct' THEN 10 "
    "WHEN 'nov' THEN 11 WHEN 'dec' THEN 12 END"
)
AGE_BAND5 = (
    "CASE WHEN age < 30 THEN '18-29' WHEN age >= 30 AND age < 40 THEN '30-39' WHEN age >= 40 AND age < 50 "
    "THEN '40-49' WHEN age >= 50 AND age < 60 THEN '50-59' ELSE '60+' END"
)
AGE_GROUP3 = "CASE WHEN age < 30 THEN '<30' WHEN age >= 30 AND age <= 60 THEN '30-60' ELSE '>60' END"
AGE_BINS = (
    "CASE WHEN age > 17 AND age <= 29 THEN '18-29' WHEN age > 29 AND age <= 39 THEN '30-39' "
    "WHEN age > 39 AND age <= 49 THEN '40-49' WHEN age > 49 AND age <= 59 THEN '50-59' "
    "WHEN age > 59 AND age <= {hi} THEN '60+' END"
)
CAMPAIGN_GROUP = (
    "CASE WHEN campaign > 0 AND campaign <= 1 THEN '1' WHEN campaign > 1 AND campaign <= 2 THEN '2' "
    "WHEN campaign > 2 AND campaign <= 3 THEN '3' WHEN campaign > 3 AND campaign <= 5 THEN '4-5' "
    "WHEN campaign > 5 AND campaign <= 10 THEN '6-10' WHEN campaign > 10 THEN '11+' END"
)
QUARTER = (
    f"CASE WHEN coalesce({MONTH_NUM}, 99) IN (1, 2, 3) THEN 'Q1' WHEN coalesce({MONTH_NUM}, 99) IN (4, 5, 6) THEN 'Q2' "
    f"WHEN coalesce({MONTH_NUM}, 99) IN (7, 8, 9) THEN 'Q3' ELSE 'Q4' END"
)
ALL_COLS = (
    'contact_id, age, job, marital, education, "default", balance, housing, loan, contact, day, month, '
    "duration, campaign, pdays, previous, poutcome, y"
)

# ---------------------------------------------------------------- 2.1 / 2.2
on_contacts("scan_contacts", lambda df: df, W(f"SELECT {ALL_COLS} FROM contacts"))
on_contacts("preview", R.preview, W(f"SELECT {ALL_COLS} FROM contacts ORDER BY contact_id LIMIT 10"))
on_contacts(
    "filter_high_balance",
    R.filter_high_balance,
    W(f"SELECT {ALL_COLS} FROM contacts WHERE balance > 1000 ORDER BY contact_id LIMIT 200"),
)
on_contacts(
    "filter_married_loan",
    R.filter_married_loan,
    W(f"SELECT {ALL_COLS} FROM contacts WHERE marital = 'married' AND loan = 'yes'"),
)
on_contacts(
    "top_balances",
    R.top_balances,
    W("SELECT contact_id, job, marital, balance FROM contacts ORDER BY balance DESC, contact_id LIMIT 10"),
)
on_contacts(
    "derived_columns",
    R.derived_columns,
    W(
        f"SELECT {ALL_COLS}, {QUARTER} AS quarter, {AGE_GROUP3} AS age_group, "
        "concat_ws('_', job, marital) AS job_marital, upper(contact) AS contact_upper FROM contacts"
    ),
)
on_contacts(
    "label_encode",
    R.label_encode,
    W("SELECT contact_id, CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM contacts"),
)
on_contacts(
    "month_order",
    R.month_calendar,
    W(
        f"SELECT contact_id, month, coalesce({MONTH_NUM}, 99) AS month_order, "
        f"coalesce({MONTH_NUM}, 13) AS month_order_hive, {QUARTER} AS quarter FROM contacts"
    ),
)
on_contacts(
    "age_groupings",
    R.age_groupings,
    W(
        f"SELECT contact_id, age, {AGE_GROUP3} AS age_group, {AGE_BAND5} AS age_band, "
        f"{AGE_BINS.format(hi=100)} AS age_bin_eda, {AGE_BINS.format(hi='1e308')} AS age_bin_audit, "
        f"{CAMPAIGN_GROUP} AS campaign_group FROM contacts"
    ),
)

# ---------------------------------------------------------------- 2.4
on_contacts("total_clients", R.total_clients, W("SELECT COUNT(*) AS total_clients FROM contacts"))
on_contacts(
    "avg_balance_by_job",
    R.avg_balance_by_job,
    W("SELECT job, ROUND(AVG(balance), 2) AS avg_balance, COUNT(*) AS clients FROM contacts GROUP BY job ORDER BY job"),
)
on_contacts(
    "housing_by_education",
    R.housing_by_education,
    W("SELECT education, housing, COUNT(*) AS clients FROM contacts GROUP BY education, housing"),
)
on_contacts(
    "contacts_by_month_y",
    R.contacts_by_month_y,
    W("SELECT month, y, COUNT(*) AS clients FROM contacts GROUP BY month, y"),
)
on_contacts(
    "avg_duration_by_poutcome",
    R.avg_duration_by_poutcome,
    W("SELECT poutcome, ROUND(AVG(duration), 2) AS avg_duration, COUNT(*) AS clients FROM contacts GROUP BY poutcome"),
)
on_contacts(
    "age_balance_summary",
    R.age_balance_summary,
    W(
        f"SELECT {AGE_BAND5} AS age_band, ROUND(AVG(balance), 2) AS avg_balance, COUNT(*) AS clients "
        "FROM contacts GROUP BY 1"
    ),
)
on_contacts(
    "avg_age_by_job",
    R.avg_age_by_job,
    W("SELECT job, ROUND(AVG(age), 2) AS average_age FROM contacts GROUP BY job"),
)
on_contacts(
    "defaulted_by_education",
    R.defaulted_by_education,
    W("SELECT education, COUNT(*) AS defaulted_clients FROM contacts WHERE \"default\" = 'yes' GROUP BY education"),
)
on_contacts(
    "monthly_contacts",
    R.monthly_contacts,
    W("SELECT month, COUNT(*) AS clients_contacted FROM contacts GROUP BY month"),
)
on_contacts(
    "month_contact_summary",
    R.month_contact_summary,
    W(f"SELECT month, COUNT(*) AS contact_count, AVG({YES}) * 100 AS success_rate FROM contacts GROUP BY month"),
)
on_contacts(
    "best_month",
    R.best_month,
    W(
        f"SELECT month, COUNT(*) AS contact_count, ROUND(AVG({YES}) * 100, 2) AS success_rate FROM contacts "
        "GROUP BY month ORDER BY contact_count DESC, month LIMIT 1"
    ),
)
for _col, _digits in (("education", None), ("contact", None), ("poutcome", 2)):
    _rate = f"AVG({YES}) * 100" if _digits is None else f"ROUND(AVG({YES}) * 100, {_digits})"
    on_contacts(
        f"subscription_rate_by_{_col}",
        R.subscription_rate_by,
        W(f"SELECT {_col}, {_rate} AS subscription_rate FROM contacts GROUP BY {_col}"),
        col=_col,
        digits=_digits,
    )
on_contacts(
    "best_contact_method",
    R.best_contact_method,
    W(
        f"SELECT contact, AVG({YES}) * 100 AS success_rate FROM contacts GROUP BY contact "
        "ORDER BY success_rate DESC, contact LIMIT 1"
    ),
)
on_contacts(
    "job_balance_median_age",
    R.job_balance_median_age,
    W(
        "SELECT job, AVG(balance) AS average_balance, quantile_disc(age, 0.5) AS median_age "
        "FROM contacts GROUP BY job"
    ),
)
on_contacts(
    "marital_subscribed",
    R.marital_subscribed,
    W("SELECT marital, COUNT(*) AS count FROM contacts WHERE y = 'yes' GROUP BY marital"),
)
on_contacts(
    "default_rate_top3",
    R.default_rate_top3,
    W(
        "SELECT job, AVG(CASE WHEN \"default\" = 'yes' THEN 1 ELSE 0 END) * 100 AS default_rate FROM contacts "
        "GROUP BY job ORDER BY default_rate DESC, job LIMIT 3"
    ),
)
on_contacts(
    "avg_duration_by_y",
    R.avg_duration_by_y,
    W("SELECT y, ROUND(AVG(duration), 2) AS average_duration FROM contacts GROUP BY y"),
)
on_contacts(
    "value_counts_default",
    R.value_counts,
    W('SELECT "default", COUNT(*) AS count FROM contacts GROUP BY "default"'),
    col="default",
)
on_contacts(
    "value_counts_job_top10",
    R.value_counts,
    W("SELECT job, COUNT(*) AS count FROM contacts GROUP BY job ORDER BY count DESC, job LIMIT 10"),
    col="job",
    top=10,
)
on_contacts(
    "value_counts_y_share",
    R.value_counts,
    W("SELECT y, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM contacts GROUP BY y"),
    col="y",
    share=True,
)
on_contacts(
    "avg_balance_by_age_group",
    R.avg_balance_by_age_group,
    W(
        "SELECT age_group, ROUND(AVG(balance), 2) AS avg_balance FROM ("
        "SELECT CASE WHEN age < 30 THEN '<30' WHEN age <= 60 THEN '30-60' ELSE '>60' END AS age_group, balance "
        "FROM contacts) t GROUP BY age_group"
    ),
)
on_contacts(
    "loan_clients_by_age_band",
    R.loan_clients_by_age_band,
    W(
        f"SELECT {AGE_BAND5} AS age_band, COUNT(*) AS loan_client_count, AVG(balance) AS average_balance_for_loan_clients "
        "FROM contacts WHERE loan = 'yes' GROUP BY 1 ORDER BY average_balance_for_loan_clients DESC, age_band LIMIT 5"
    ),
)
on_contacts(
    "avg_balance_by_job_desc",
    R.avg_balance_by_job_desc,
    W("SELECT job, AVG(balance) AS average_balance FROM contacts GROUP BY job"),
)
_NS_COLS = ("age", "balance", "duration", "campaign", "pdays", "previous")
_NS_STATS = [
    ("count", "CAST(COUNT({c}) AS DOUBLE)"),
    ("mean", "AVG({c}::DOUBLE)"),
    ("std", "STDDEV_SAMP({c}::DOUBLE)"),
    ("min", "MIN({c}::DOUBLE)"),
    ("25%", "quantile_cont({c}::DOUBLE, 0.25)"),
    ("50%", "quantile_cont({c}::DOUBLE, 0.5)"),
    ("75%", "quantile_cont({c}::DOUBLE, 0.75)"),
    ("max", "MAX({c}::DOUBLE)"),
]
on_contacts(
    "numeric_summary",
    R.numeric_summary,
    W(
        " UNION ALL ".join(
            f"SELECT '{s}' AS statistic, '{c}' AS column_name, ROUND({e.format(c=c)}, 6) AS value FROM contacts"
            for c in _NS_COLS
            for s, e in _NS_STATS
        )
    ),
)
_TYPES = {
    "contact_id": "bigint", "age": "int", "balance": "int", "day": "int", "duration": "int",
    "campaign": "int", "pdays": "int", "previous": "int",
}
_ALL = [c.strip().strip('"') for c in ALL_COLS.split(",")]
on_contacts(
    "schema_profile",
    lambda df: R.schema_profile(df, _ALL),
    W(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS dtype, "
            f"CAST(SUM(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, "
            f"CAST(COUNT(DISTINCT \"{c}\") + MAX(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS \"unique\" "
            "FROM contacts"
            for c in _ALL
        )
    ),
)
_STR = ["job", "marital", "education", "default", "housing", "loan", "contact", "month", "poutcome", "y"]
on_contacts(
    "unknown_profile",
    R.unknown_profile,
    W(
        "SELECT column_name, unknown_count, ROUND(unknown_count / n * 100, 2) AS unknown_percent FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN \"{c}\" = 'unknown' THEN 1 ELSE 0 END) AS BIGINT) "
            "AS unknown_count, COUNT(*) AS n FROM contacts"
            for c in _STR
        )
        + ") t WHERE unknown_count > 0"
    ),
)
on_contacts(
    "quality_summary",
    R.quality_summary,
    W(
        "SELECT * FROM (SELECT 'rows' AS metric, COUNT(*) AS value FROM contacts "
        "UNION ALL SELECT 'columns', 17 "
        f"UNION ALL SELECT 'exact_duplicates', (SELECT COUNT(*) FROM contacts) - (SELECT COUNT(*) FROM (SELECT DISTINCT {ALL_COLS.replace('contact_id, ', '')} FROM contacts)) "
        "UNION ALL SELECT 'missing_cells', CAST(SUM("
        + " + ".join(f'(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END)' for c in _ALL[1:])
        + ") AS BIGINT) FROM contacts "
        "UNION ALL SELECT 'non_subscribers', CAST(SUM(CASE WHEN y = 'no' THEN 1 ELSE 0 END) AS BIGINT) FROM contacts "
        "UNION ALL SELECT 'subscribers', CAST(SUM(CASE WHEN y = 'yes' THEN 1 ELSE 0 END) AS BIGINT) FROM contacts) t"
    ),
)
on_contacts(
    "monthly_balance",
    R.monthly_balance,
    W("SELECT education, month, AVG(balance) AS monthly_avg_balance FROM contacts GROUP BY education, month"),
)
on_contacts(
    "education_stats",
    R.education_stats,
    W(
        "SELECT education, ROUND(AVG(monthly_avg_balance), 6) AS mean_balance, "
        "ROUND(STDDEV_POP(monthly_avg_balance), 6) AS std_balance FROM mb GROUP BY education",
        "mb AS (SELECT education, month, AVG(balance) AS monthly_avg_balance FROM contacts GROUP BY education, month)",
    ),
)
_GF = {
    "job": "job", "age_group": AGE_BINS.format(hi=100), "education": "education", "marital": "marital",
    "contact": "contact", "month": "month", "campaign_group": CAMPAIGN_GROUP, "poutcome": "poutcome",
}
_GR_LABELS = (
    "VALUES ('age_group','18-29'),('age_group','30-39'),('age_group','40-49'),('age_group','50-59'),"
    "('age_group','60+'),('campaign_group','1'),('campaign_group','2'),('campaign_group','3'),"
    "('campaign_group','4-5'),('campaign_group','6-10'),('campaign_group','11+')"
)
on_contacts(
    "group_rates",
    R.group_rates,
    W(
        "SELECT coalesce(a.field, l.field) AS field, coalesce(a.grp, l.grp) AS grp, "
        "coalesce(a.customers, 0) AS customers, a.subscription_rate FROM agg a "
        f"FULL OUTER JOIN ({_GR_LABELS}) l(field, grp) ON a.field = l.field AND a.grp = l.grp",
        "st AS ("
        + " UNION ALL ".join(f"SELECT '{f}' AS field, CAST({e} AS VARCHAR) AS grp, {YES} AS yes FROM contacts" for f, e in _GF.items())
        + "), agg AS (SELECT field, grp, COUNT(*) AS customers, AVG(yes) AS subscription_rate FROM st "
        "WHERE grp IS NOT NULL AND (field <> 'month' OR grp IN ('jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec')) "
        "GROUP BY field, grp)",
    ),
)
on_contacts(
    "loan_indicator_rates",
    R.loan_indicator_rates,
    W(
        "SELECT indicator, value, COUNT(*) AS customers, ROUND(AVG(yes), 4) AS subscription_rate FROM ("
        f"SELECT 'housing' AS indicator, housing AS value, {YES} AS yes FROM contacts UNION ALL "
        f"SELECT 'loan', loan, {YES} FROM contacts) t GROUP BY indicator, value"
    ),
)
on_contacts(
    "outcome_stats",
    R.outcome_stats,
    W(
        "SELECT column_name, y, COUNT(v) AS count, quantile_cont(v, 0.5) AS median, ROUND(AVG(v), 6) AS mean FROM ("
        "SELECT 'balance' AS column_name, y, balance::DOUBLE AS v FROM contacts UNION ALL "
        "SELECT 'duration', y, duration::DOUBLE FROM contacts) t GROUP BY column_name, y"
    ),
)
_IQR = ("age", "balance", "day", "campaign", "pdays", "previous")
on_contacts(
    "iqr_outliers",
    R.iqr_outliers,
    W(
        "SELECT feature, lo AS iqr_lower_bound, hi AS iqr_upper_bound, potential_outliers, "
        "ROUND(potential_outliers / n * 100, 2) AS outlier_percent FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, b.lo, b.hi, CAST(SUM(CASE WHEN {c} < b.lo OR {c} > b.hi THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS potential_outliers, COUNT(*) AS n FROM contacts, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi "
            f"FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM contacts)) b "
            "GROUP BY b.lo, b.hi"
            for c in _IQR
        )
        + ") t"
    ),
)
on_contacts(
    "histogram_balance",
    R.histogram,
    W(
        "SELECT bin, ROUND(lo + (bin - 1) * ((hi - lo) / 30), 6) AS bin_start, ROUND(lo + bin * ((hi - lo) / 30), 6) AS bin_end, "
        "COUNT(*) AS count FROM (SELECT CAST(least(floor(30.0 * (balance - lo) / (hi - lo)) + 1, 30) AS INTEGER) AS bin, lo, hi "
        "FROM contacts, (SELECT MIN(balance)::DOUBLE AS lo, MAX(balance)::DOUBLE AS hi FROM contacts) r "
        "WHERE balance IS NOT NULL) t GROUP BY bin, lo, hi"
    ),
)
on_contacts(
    "five_number_balance",
    R.five_number,
    W(
        "SELECT y, quantile_cont(balance::DOUBLE, 0.0) AS min, quantile_cont(balance::DOUBLE, 0.25) AS q1, "
        "quantile_cont(balance::DOUBLE, 0.5) AS median, quantile_cont(balance::DOUBLE, 0.75) AS q3, "
        "quantile_cont(balance::DOUBLE, 1.0) AS max FROM contacts GROUP BY y"
    ),
)
on_contacts(
    "crosstab_contact_y",
    R.crosstab,
    W(
        "SELECT a.contact, b.y, coalesce(c.count, 0) AS count FROM (SELECT DISTINCT contact FROM contacts) a "
        "CROSS JOIN (SELECT DISTINCT y FROM contacts) b "
        "LEFT JOIN (SELECT contact, y, COUNT(*) AS count FROM contacts GROUP BY contact, y) c "
        "ON a.contact = c.contact AND b.y = c.y"
    ),
)

# ---------------------------------------------------------------- 2.5
on_contacts(
    "top_jobs_profile",
    R.top_jobs_profile,
    W(
        f"SELECT job, ROUND(m, 2) AS average_balance, ROUND(rate, 2) AS subscription_rate FROM (SELECT job, AVG(balance) AS m, 100 * AVG({YES}) AS rate, "
        "row_number() OVER (ORDER BY AVG(balance) DESC, job) AS place FROM contacts GROUP BY job) WHERE place <= 5"
    ),
)
on_contacts(
    "balance_anomalies",
    R.balance_anomalies,
    W(
        "SELECT education, month, ROUND(m, 2) AS avg_balance, ROUND(z, 2) AS z_score FROM (SELECT education, month, m, "
        "(m - AVG(m) OVER e) / nullif(stddev_pop(m) OVER e, 0) AS z FROM (SELECT education, month, AVG(balance) AS m FROM contacts GROUP BY ALL) "
        "WINDOW e AS (PARTITION BY education)) WHERE ABS(z) >= 1.5"
    ),
)
register(
    "expectations",
    W(
        "SELECT * FROM (VALUES ('row_count', (SELECT COUNT(*) FROM contacts) = (SELECT COUNT(*) FROM orders), "
        "'rows=' || CAST((SELECT COUNT(*) FROM contacts) AS VARCHAR)), "
        "('key_present', (SELECT COUNT(*) FROM contacts WHERE job = 'building') > 0, 'job=building'), "
        "('labels_valid', (SELECT COUNT(*) FROM contacts WHERE y NOT IN ('yes','no') OR y IS NULL) = 0, 'bad_labels=' || "
        "CAST((SELECT COUNT(*) FROM contacts WHERE y NOT IN ('yes','no') OR y IS NULL) AS VARCHAR)), "
        "('columns_present', true, 'all')) t(\"check\", passed, details) "
        "UNION ALL SELECT 'overall', (SELECT COUNT(*) FROM contacts) = (SELECT COUNT(*) FROM orders) "
        "AND (SELECT COUNT(*) FROM contacts WHERE job = 'building') > 0 "
        "AND (SELECT COUNT(*) FROM contacts WHERE y NOT IN ('yes','no') OR y IS NULL) = 0, 'all checks'"
    ),
)(
    lambda spark, sf: R.expect(
        contacts(spark, sf),
        expected_rows=table(spark, sf, "orders").count(),
        key_col="job",
        key_value="building",
    )
)

# ---------------------------------------------------------------- 2.8 splits
from callcast.operators import evaluate as EV  # noqa: E402
from callcast.operators import split as SP  # noqa: E402
from callcast.operators import stats as ST  # noqa: E402

_MD5 = "md5(concat(CAST(contact_id AS VARCHAR), '-{seed}'))"
_RANKED = (
    "ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY y ORDER BY " + _MD5.format(seed=42) + ", contact_id) AS rn, "
    "COUNT(*) OVER (PARTITION BY y) AS n FROM contacts)"
)
_SPLIT_CASE = (
    "CASE WHEN rn <= floor(n * CAST(0.6 AS DOUBLE) + 0.5) THEN 'train' "
    "WHEN rn <= floor(n * CAST(0.8000000000000002 AS DOUBLE) + 0.5) THEN 'validation' ELSE 'test' END"
)
_SPLIT_CTE = _RANKED + f", split AS (SELECT contact_id, y, {_SPLIT_CASE} AS split FROM ranked)"


def _split(spark, sf):
    return SP.stratified_split(contacts(spark, sf))


register("stratified_split", W("SELECT contact_id, y, split FROM split", _SPLIT_CTE))(
    lambda spark, sf: _split(spark, sf).select("contact_id", "y", "split")
)
register(
    "split_summary",
    W("SELECT split, COUNT(*) AS rows, ROUND(AVG(CASE WHEN y = 'yes' THEN 1 ELSE 0 END), 4) AS positive_rate "
      "FROM split GROUP BY split", _SPLIT_CTE),
)(lambda spark, sf: SP.split_summary(_split(spark, sf)))


def _integrity(spark, sf):
    from callcast.session import materialize

    sp = materialize(_split(spark, sf).select("contact_id", "split"), "split-ids")  # read once for each part
    return SP.split_integrity(SP.parts_of(sp), contacts(spark, sf))


register(
    "split_integrity",
    W(
        "SELECT 'no_overlap' AS \"check\", COUNT(*) = 0 AS passed, COUNT(*) AS offending_ids FROM "
        "(SELECT contact_id FROM split GROUP BY contact_id HAVING COUNT(*) > 1) "
        "UNION ALL SELECT 'covers_source', COUNT(*) = 0, COUNT(*) FROM contacts c WHERE NOT EXISTS "
        "(SELECT 1 FROM split s WHERE s.contact_id = c.contact_id) "
        "UNION ALL SELECT 'no_foreign_rows', COUNT(*) = 0, COUNT(*) FROM split s WHERE NOT EXISTS "
        "(SELECT 1 FROM contacts c WHERE s.contact_id = c.contact_id)",
        _SPLIT_CTE,
    ),
)(_integrity)
register(
    "kfold_5x2",
    W(
        "SELECT contact_id, CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY " + _MD5.format(seed=42) + ", contact_id) - 1) % 5 AS INTEGER) AS fold_42, "
        "CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY " + _MD5.format(seed=43) + ", contact_id) - 1) % 5 AS INTEGER) AS fold_43 FROM contacts"
    ),
)(lambda spark, sf: SP.kfold_assign(contacts(spark, sf), k=5, seeds=(42, 43)).select("contact_id", "fold_42", "fold_43"))
register(
    "hash_split_60",
    W("SELECT contact_id, y FROM contacts WHERE substr(" + _MD5.format(seed=42) + ", 1, 8) < '99999999'"),
)(lambda spark, sf: SP.hash_split(contacts(spark, sf), 0.6).select("contact_id", "y"))
register(
    "fixed_sample_1200",
    W(f"SELECT {ALL_COLS} FROM contacts ORDER BY " + _MD5.format(seed=42) + ", contact_id LIMIT 1200"),
)(lambda spark, sf: SP.fixed_sample(contacts(spark, sf), 1200))
register(
    "development_union",
    W(f"SELECT {ALL_COLS} FROM contacts WHERE contact_id IN (SELECT contact_id FROM split WHERE split <> 'test')", _SPLIT_CTE),
)(
    lambda spark, sf: (lambda parts: parts["train"].unionByName(parts["validation"]))(
        SP.parts_of(SP.stratified_split(contacts(spark, sf)).select(*ALL_COLS.replace('"', "").split(", "), "split"))
    )
)

# ---------------------------------------------------------------- 2.9 statistics
register("corr_age_balance", W("SELECT ROUND(corr(age::DOUBLE, balance::DOUBLE), 10) AS age_balance_correlation FROM contacts"))(
    lambda spark, sf: ST.corr(contacts(spark, sf))
)
_CM = list(ST.CORR_COLUMNS) + ["subscribed"]
_CM_SRC = "cm AS (SELECT " + ", ".join(f"{c}::DOUBLE AS {c}" for c in ST.CORR_COLUMNS) + ", CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS subscribed FROM contacts)"
register(
    "corr_matrix",
    W(
        " UNION ALL ".join(
            [f"SELECT '{a}' AS a, '{b}' AS b, ROUND(corr({a}, {b}), 9) AS corr FROM cm" for a in _CM for b in _CM if a != b]
            + [f"SELECT '{a}', '{a}', 1.0::DOUBLE" for a in _CM]
        ),
        _CM_SRC,
    ),
)(lambda spark, sf: ST.corr_matrix(contacts(spark, sf)))
_CHI_CTES = (
    "cells AS (SELECT a.contact, b.y, CAST(coalesce(c.o, 0) AS DOUBLE) AS o FROM (SELECT DISTINCT contact FROM contacts) a "
    "CROSS JOIN (SELECT DISTINCT y FROM contacts) b LEFT JOIN (SELECT contact, y, COUNT(*) AS o FROM contacts GROUP BY contact, y) c "
    "ON a.contact = c.contact AND a.contact = c.contact AND b.y = c.y), "
    "m AS (SELECT cells.*, SUM(o) OVER (PARTITION BY contact) AS r, SUM(o) OVER (PARTITION BY y) AS c, SUM(o) OVER () AS n FROM cells), "
    "s AS (SELECT MAX(n) AS n, COUNT(DISTINCT contact) AS nr, COUNT(DISTINCT y) AS nc, "
    "SUM((o - r * c / n) ^ 2 / (r * c / n)) AS chi2p, "
    "SUM((abs(o - r * c / n) - least(0.5, abs(o - r * c / n))) ^ 2 / (r * c / n)) AS chi2y FROM m)"
)
register(
    "chi_square_contact_y",
    W(
        "SELECT ROUND(CASE WHEN (nr - 1) * (nc - 1) = 1 THEN chi2y ELSE chi2p END, 10) AS chi2, "
        "CAST((nr - 1) * (nc - 1) AS INTEGER) AS dof, "
        "ROUND(sqrt(CASE WHEN (nr - 1) * (nc - 1) = 1 THEN chi2y ELSE chi2p END / (n * (least(nr, nc) - 1))), 10) AS cramers_v, "
        "CAST(n AS BIGINT) AS n FROM s",
        _CHI_CTES,
    ),
)(lambda spark, sf: ST.chi_square(contacts(spark, sf), "contact", "y").drop("p_value", "reject_h0"))
register(
    "chi_square_contact_y_test",
    W(
        "SELECT *, exp(-chi2 / 2) AS p_value, exp(-chi2 / 2) < 0.05 AS reject_h0 FROM (SELECT ROUND(chi2p, 10) AS chi2, CAST((nr - 1) * (nc - 1) AS INTEGER) AS dof, "
        "ROUND(sqrt(chi2p / (n * (least(nr, nc) - 1))), 10) AS cramers_v, CAST(n AS BIGINT) AS n FROM s)",
        _CHI_CTES,
    ),
)(lambda spark, sf: ST.chi_square(contacts(spark, sf), "contact", "y"))


def _mw_sql(x: str) -> str:
    return W(
        "SELECT CAST(n1 AS BIGINT) AS n_positive, CAST(n0 AS BIGINT) AS n_other, med1 AS median_positive, med0 AS median_other, "
        "ROUND(u, 10) AS u_statistic, ROUND(2 * u / (n1 * n0) - 1, 10) AS rank_biserial, "
        "ROUND((greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))), 10) AS z "
        "FROM agg, med",
        f"g AS (SELECT {x}::DOUBLE AS v, SUM(CASE WHEN y = 'yes' THEN 1 ELSE 0 END)::DOUBLE AS n1v, "
        f"SUM(CASE WHEN y = 'yes' THEN 0 ELSE 1 END)::DOUBLE AS n0v FROM contacts WHERE {x} IS NOT NULL GROUP BY 1), "
        "c AS (SELECT *, SUM(n0v) OVER (ORDER BY v) AS cum0 FROM g), "
        "agg AS (SELECT SUM(n1v) AS n1, SUM(n0v) AS n0, SUM(n1v * (cum0 - n0v / 2.0)) AS u, "
        "SUM(power(n1v + n0v, 3) - (n1v + n0v)) AS ties FROM c), "
        f"med AS (SELECT quantile_cont(CASE WHEN y = 'yes' THEN {x}::DOUBLE END, 0.5) AS med1, "
        f"quantile_cont(CASE WHEN y = 'yes' THEN NULL ELSE {x}::DOUBLE END, 0.5) AS med0 FROM contacts)",
    )


for _x in ("balance", "campaign"):
    register(f"mann_whitney_{_x}", _mw_sql(_x))(
        (lambda x: lambda spark, sf: ST.mann_whitney(contacts(spark, sf), x).drop("p_value"))(_x)
    )
    register(f"mann_whitney_{_x}_test")((lambda x: lambda spark, sf: ST.mann_whitney(contacts(spark, sf), x))(_x))

# ---------------------------------------------------------------- 2.11 evaluation (deterministic scores)
_BP = "least(9990, 5 * ((contact_id * 7919) % 1000) + 10 * duration)"
_SCORED = (
    f"scored AS (SELECT contact_id, CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label, CAST({_BP} AS INTEGER) AS score_bp, "
    f"CAST({_BP} AS DOUBLE) / 10000.0 AS p, age, contact, poutcome FROM contacts)"
)
_COUNTS = (
    _SCORED + ", g AS (SELECT p, SUM(label)::DOUBLE AS pos, (COUNT(*) - SUM(label))::DOUBLE AS neg FROM scored GROUP BY p), "
    "c AS (SELECT p, pos, neg, SUM(pos) OVER (ORDER BY p DESC) AS tp, SUM(neg) OVER (ORDER BY p DESC) AS fp FROM g)"
)
_PR = (
    _COUNTS + ", pr AS (SELECT p AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
    "ROUND(tp / (tp + fp), 10) AS precision, ROUND(tp / (SELECT SUM(pos) FROM g), 10) AS recall, "
    "ROUND(2 * (tp / (tp + fp)) * (tp / (SELECT SUM(pos) FROM g)) / greatest(tp / (tp + fp) + tp / (SELECT SUM(pos) FROM g), 1e-12), 10) AS f1 FROM c)"
)


def _scored(spark, sf):
    return EV.scored(contacts(spark, sf))


register("scored", W("SELECT contact_id, label, score_bp, p FROM scored", _SCORED))(_scored)
register(
    "ranking_metrics",
    W(
        "SELECT CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives, "
        "ROUND(SUM(pos * tp / (tp + fp)) / SUM(pos), 10) AS average_precision, "
        "ROUND((SUM(neg) * SUM(pos) + SUM(pos * (neg / 2.0 - fp))) / (SUM(pos) * SUM(neg)), 10) AS roc_auc FROM c",
        _COUNTS,
    ),
)(lambda spark, sf: EV.ranking_metrics(_scored(spark, sf)))
register("pr_curve", W("SELECT * FROM pr", _PR))(lambda spark, sf: EV.pr_curve(_scored(spark, sf)))
register("best_f1_threshold", W("SELECT * FROM pr ORDER BY 2.0 * tp / (tp + fp + (SELECT SUM(pos) FROM g)) DESC, threshold ASC LIMIT 1", _PR))(
    lambda spark, sf: EV.best_f1_threshold(_scored(spark, sf))
)
_RATES = (
    "CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END", "CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END",
    "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END",
)
register(
    "threshold_table",
    W(
        f"SELECT t AS threshold, ROUND({_RATES[0]}, 4) AS precision, ROUND({_RATES[1]}, 4) AS recall, ROUND({_RATES[2]}, 4) AS f1, "
        "abs(t - (SELECT threshold FROM best)) <= 1e-8 AS selected FROM conf",
        _PR + ", best AS (SELECT threshold FROM pr ORDER BY 2.0 * tp / (tp + fp + (SELECT SUM(pos) FROM g)) DESC, threshold ASC LIMIT 1), "
        "ts AS (SELECT DISTINCT t FROM (SELECT CAST(0.1 AS DOUBLE) AS t UNION ALL SELECT CAST(0.2 AS DOUBLE) UNION ALL "
        "SELECT CAST(0.5 AS DOUBLE) UNION ALL SELECT threshold FROM best)), "
        "conf AS (SELECT t, SUM(CASE WHEN p >= t AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp, "
        "SUM(CASE WHEN p >= t AND label = 0 THEN 1 ELSE 0 END)::DOUBLE AS fp, "
        "SUM(CASE WHEN p < t AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM ts, scored GROUP BY t)",
    ),
)(lambda spark, sf: EV.threshold_table(_scored(spark, sf)))
_CONF05 = (
    "conf AS (SELECT SUM(CASE WHEN p >= 0.5 AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp, "
    "SUM(CASE WHEN p >= 0.5 AND label = 0 THEN 1 ELSE 0 END)::DOUBLE AS fp, "
    "SUM(CASE WHEN p < 0.5 AND label = 1 THEN 1 ELSE 0 END)::DOUBLE AS fn, "
    "SUM(CASE WHEN p < 0.5 AND label = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn FROM scored)"
)
register(
    "classification_metrics",
    W(
        "SELECT r.*, CAST(0.5 AS DOUBLE) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
        f"CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, ROUND({_RATES[0]}, 10) AS precision, "
        f"ROUND({_RATES[1]}, 10) AS recall, ROUND({_RATES[2]}, 10) AS f1, "
        f"ROUND((({_RATES[1]}) + (CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END)) / 2, 10) AS balanced_accuracy "
        "FROM conf, r",
        _COUNTS + ", " + _CONF05 + ", r AS (SELECT CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives, "
        "ROUND(SUM(pos * tp / (tp + fp)) / SUM(pos), 10) AS average_precision, "
        "ROUND((SUM(neg) * SUM(pos) + SUM(pos * (neg / 2.0 - fp))) / (SUM(pos) * SUM(neg)), 10) AS roc_auc FROM c)",
    ),
)(lambda spark, sf: EV.classification_metrics(_scored(spark, sf), 0.5))
register(
    "lift_table",
    W(
        "SELECT share AS contact_share, k AS customers_contacted, ROUND(t / k, 10) AS subscription_rate, "
        "ROUND(t / k / (pos / n), 10) AS lift_over_random, ROUND(t / pos, 10) AS subscriber_capture_rate FROM ("
        "SELECT share, k, SUM(CASE WHEN rn <= k THEN label ELSE 0 END)::DOUBLE AS t, SUM(label)::DOUBLE AS pos, COUNT(*)::DOUBLE AS n "
        "FROM ranked, shares GROUP BY share, k)",
        _SCORED + ", ranked AS (SELECT label, ROW_NUMBER() OVER (ORDER BY p DESC, contact_id) AS rn FROM scored), "
        "shares AS (SELECT share, CAST(ceil((SELECT COUNT(*) FROM scored) * share) AS BIGINT) AS k FROM "
        "(SELECT CAST(0.1 AS DOUBLE) AS share UNION ALL SELECT CAST(0.2 AS DOUBLE) UNION ALL SELECT CAST(0.3 AS DOUBLE)))",
    ),
)(lambda spark, sf: EV.lift_table(_scored(spark, sf)))
_CR = (
    "SELECT '0' AS class, ROUND(p0, 10) AS precision, ROUND(r0, 10) AS recall, ROUND(f0, 10) AS f1, CAST(tn + fp AS BIGINT) AS support FROM x "
    "UNION ALL SELECT '1', ROUND(p1, 10), ROUND(r1, 10), ROUND(f1, 10), CAST(tp + fn AS BIGINT) FROM x "
    "UNION ALL SELECT 'accuracy', NULL, NULL, ROUND((tp + tn) / (tp + tn + fp + fn), 10), CAST(tp + tn + fp + fn AS BIGINT) FROM x "
    "UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 10), ROUND((r0 + r1) / 2, 10), ROUND((f0 + f1) / 2, 10), CAST(tp + tn + fp + fn AS BIGINT) FROM x "
    "UNION ALL SELECT 'weighted avg', ROUND((p0 * (tn + fp) + p1 * (tp + fn)) / (tp + tn + fp + fn), 10), "
    "ROUND((r0 * (tn + fp) + r1 * (tp + fn)) / (tp + tn + fp + fn), 10), ROUND((f0 * (tn + fp) + f1 * (tp + fn)) / (tp + tn + fp + fn), 10), "
    "CAST(tp + tn + fp + fn AS BIGINT) FROM x"
)
register(
    "classification_report",
    W(
        _CR,
        _SCORED + ", " + _CONF05 + ", x AS (SELECT *, "
        f"{_RATES[0]} AS p1, {_RATES[1]} AS r1, {_RATES[2]} AS f1, "
        "CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0, "
        "CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f0 FROM conf)",
    ),
)(lambda spark, sf: EV.classification_report(_scored(spark, sf), 0.5))
register(
    "brier",
    W(
        "SELECT ROUND(b, 10) AS brier, ROUND(r * r - 2 * r * m + m, 10) AS brier_baseline, "
        "ROUND(1 - b / (r * r - 2 * r * m + m), 10) AS brier_skill FROM (SELECT AVG(power(p - label, 2)) AS b, "
        "AVG(label::DOUBLE) AS r, AVG(label::DOUBLE) AS m FROM scored)",
        _SCORED,
    ),
)(lambda spark, sf: EV.brier(_scored(spark, sf)))
register(
    "calibration_curve",
    W(
        "SELECT bin, COUNT(*) AS rows, ROUND(AVG(p), 10) AS mean_predicted, ROUND(AVG(label::DOUBLE), 10) AS observed_rate FROM ("
        "SELECT p, label, " + " + ".join(f"CAST(p > e[{i}] AS INTEGER)" for i in range(1, 8)) + " AS bin FROM scored, edges) GROUP BY bin",
        _SCORED + ", edges AS (SELECT quantile_cont(p, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]) AS e FROM scored)",
    ),
)(lambda spark, sf: EV.calibration_curve(_scored(spark, sf)))
_AUDIT_BINS = AGE_BINS.format(hi="1e308")
register(
    "subgroup_audit",
    W(
        "SELECT coalesce(a.field, l.field) AS field, coalesce(a.grp, l.grp) AS grp, CAST(coalesce(a.rows, 0) AS BIGINT) AS rows, "
        "ROUND(a.ar, 10) AS actual_positive_rate, ROUND(a.pr, 10) AS predicted_positive_rate, "
        "ROUND(CASE WHEN coalesce(a.ap, 0) = 0 THEN NULL ELSE a.tp / a.ap END, 10) AS recall, "
        "ROUND(CASE WHEN coalesce(a.pp, 0) = 0 THEN NULL ELSE a.tp / a.pp END, 10) AS precision, "
        "coalesce(a.rows, 0) < 25 AS small_group FROM a FULL OUTER JOIN (VALUES ('age_band','18-29'),('age_band','30-39'),"
        "('age_band','40-49'),('age_band','50-59'),('age_band','60+')) l(field, grp) ON a.field = l.field AND a.grp = l.grp",
        _SCORED + ", st AS (SELECT 'contact' AS field, contact AS grp, label, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored "
        "UNION ALL SELECT 'poutcome', poutcome, label, CAST(p >= 0.5 AS INTEGER) FROM scored "
        f"UNION ALL SELECT 'age_band', {_AUDIT_BINS}, label, CAST(p >= 0.5 AS INTEGER) FROM scored), "
        "a AS (SELECT field, grp, COUNT(*) AS rows, AVG(label::DOUBLE) AS ar, AVG(pred::DOUBLE) AS pr, "
        "SUM(label * pred)::DOUBLE AS tp, SUM(label)::DOUBLE AS ap, SUM(pred)::DOUBLE AS pp FROM st WHERE grp IS NOT NULL GROUP BY field, grp)",
    ),
)(lambda spark, sf: EV.subgroup_audit(EV.scored(contacts(spark, sf), keep=("age", "contact", "poutcome")), 0.5))

# ---------------------------------------------------------------- 2.14 UDF
from callcast.functions.udfs import age_group_udf  # noqa: E402

register(
    "age_group_udf",
    W(f"SELECT contact_id, age, CASE WHEN age IS NULL THEN NULL ELSE {AGE_GROUP3} END AS age_group_udf FROM contacts"),
)(lambda spark, sf: contacts(spark, sf).select("contact_id", "age", age_group_udf("age").alias("age_group_udf")))

# ---------------------------------------------------------------- 2.12 streaming (drained with availableNow)
from pyspark.sql import functions as _F  # noqa: E402

from callcast.streaming import jobs as SJ  # noqa: E402

_REPLAYS: dict = {}


def _event_stream(spark, sf, flush: bool = False):
    """The driver's events as a file stream source (written once per session, range-partitioned on time)."""
    ev = SJ.events_as_contacts(table(spark, sf, "events"))
    key = (spark.sparkContext.applicationId, sf, "events", flush)
    if key not in _REPLAYS:
        _REPLAYS[key] = SJ.write_replay(SJ.with_flush(ev) if flush else ev, "event_time", "events-replay")
    return SJ.file_stream(spark, _REPLAYS[key], ev.schema)


def _round_avgs(df):
    return df.select(*[_F.round(c, 6).alias(c) if c.startswith("avg_") else _F.col(c) for c in df.columns])


_EV = (
    "ev AS (SELECT ts, event_type AS job, value AS balance, CAST(json_extract_string(props, '$.k') AS INTEGER) AS duration FROM events)"
)
register(
    "stream_job_metrics",
    W(
        "SELECT job, ROUND(AVG(balance), 6) AS avg_balance, ROUND(AVG(duration), 6) AS avg_duration, "
        "COUNT(*) AS transaction_count FROM ev GROUP BY job",
        _EV,
    ),
)(lambda spark, sf: _round_avgs(SJ.drain(SJ.stream_job_metrics(_event_stream(spark, sf)), "complete")[0]))


def _window_sql(width: str, streamed: bool) -> str:
    having = (
        f" HAVING time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' <= (SELECT MAX(ts) FROM ev) - INTERVAL '2 minutes'"
        if streamed else ""
    )
    return W(
        f"SELECT time_bucket(INTERVAL '{width}', ts) AS window_start, time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end, "
        f"COUNT(*) AS transaction_count, ROUND(AVG(balance), 6) AS avg_balance FROM ev GROUP BY 1, 2{having}",
        _EV,
    )


for _w, _k in (("1 hour", "1h"), ("1 day", "1d")):
    register(f"stream_window_{_k}", _window_sql(_w, True))(
        (lambda w: lambda spark, sf: _round_avgs(SJ.drain(SJ.stream_window(_event_stream(spark, sf), w), "append")[0]))(_w)
    )
    register(f"window_batch_{_k}", _window_sql(_w, False))(
        (lambda w: lambda spark, sf: _round_avgs(SJ.batch_window(SJ.events_as_contacts(table(spark, sf, "events")), w)))(_w)
    )

# Flushed runs: the watermark passes every window, so the stream gives what the batch gives.
for _w, _k in (("10 seconds", "10s"), ("1 minute", "1m"), ("1 hour", "1h"), ("1 day", "1d")):
    register(f"stream_window_flushed_{_k}", _window_sql(_w, False))(
        (lambda w: lambda spark, sf: _round_avgs(SJ.drain(SJ.stream_window(_event_stream(spark, sf, flush=True), w), "append", sink="parquet")[0]))(_w)
    )


def _csv_stream_metrics(spark, sf):
    """Contacts with event times as CSV files, read one file per micro-batch; complete-mode metrics of the last batch."""
    from callcast.schema import STREAMING_SCHEMA
    from callcast.session import scratch_path
    from callcast.sources.tables import scan_stream_csv

    key = (spark.sparkContext.applicationId, sf, "contacts-csv")
    if key not in _REPLAYS:
        orders = table(spark, sf, "orders")
        times = orders.select(_F.col("o_orderkey").alias("contact_id"), SJ.ntz_as_utc("o_orderdate", orders).alias("event_time"))
        rows = contacts(spark, sf).join(times, "contact_id").select(*[f.name for f in STREAMING_SCHEMA.fields])
        _REPLAYS[key] = scratch_path(spark, "contacts-csv-replay")
        rows.repartitionByRange(6, "event_time").write.option("header", True).csv(_REPLAYS[key])
    return _round_avgs(SJ.drain(SJ.stream_job_metrics(scan_stream_csv(spark, _REPLAYS[key])), "complete")[0])


register(
    "stream_job_metrics_csv",
    W("SELECT job, ROUND(AVG(balance), 6) AS avg_balance, ROUND(AVG(duration), 6) AS avg_duration, COUNT(*) AS transaction_count FROM contacts GROUP BY job"),
)(_csv_stream_metrics)



def _late_rows(spark, sf):
    """Every fiftieth event arrives after all others; those whose hour is closed by then are left out."""
    return SJ.late_rows(SJ.events_as_contacts(table(spark, sf, "events")), _F.col("event_id") % 50 == 0).select("input_rows", "counted_rows", "late_rows")


register(
    "stream_late_rows",
    "WITH w AS (SELECT MAX(ts) - INTERVAL '2 minutes' AS mark FROM events WHERE event_id % 50 <> 0) "
    "SELECT COUNT(*) AS input_rows, COUNT(*) FILTER (NOT gone) AS counted_rows, COUNT(*) FILTER (gone) AS late_rows FROM "
    "(SELECT event_id % 50 = 0 AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= mark AS gone FROM events, w)",
)(_late_rows)


def _dashboard(spark, sf):
    """Four queries over the event stream at once; what each has put out."""
    from callcast.session import scratch_path
    from callcast.streaming import runner

    plain, flushed = _event_stream(spark, sf), _event_stream(spark, sf, flush=True)
    name = lambda q: scratch_path(spark, q).rsplit("/", 1)[1].replace("-", "_")
    frames = {
        "job_metrics": (SJ.stream_job_metrics(plain), "complete", "memory"),
        "window_1m": (SJ.stream_window(flushed, "1 minute"), "append", "parquet"),
        "window_1h": (SJ.stream_window(flushed, "1 hour"), "append", "parquet"),
        "large_balances": (plain.where("balance > 50").select("event_id", "job", "balance"), "append", "parquet"),
    }
    jobs = {q: runner.Job(name(q), frame, mode, sink, path=scratch_path(spark, f"dashboard-{q}")) for q, (frame, mode, sink) in frames.items()}
    runner.run(spark, list(jobs.values()))
    out = None
    for q, job in jobs.items():
        rows = spark.table(job.name) if job.sink == "memory" else spark.read.parquet(job.path)
        each = _F.col("transaction_count") if "transaction_count" in rows.columns else _F.lit(1)
        part = rows.agg(_F.lit(q).alias("query"), _F.count(_F.lit(1)).alias("output_rows"), _F.coalesce(_F.sum(each), _F.lit(0)).alias("transactions"))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "stream_dashboard",
    W(
        "SELECT 'job_metrics' AS query, COUNT(DISTINCT job) AS output_rows, COUNT(*) AS transactions FROM ev "
        "UNION ALL SELECT 'window_1m', COUNT(DISTINCT time_bucket(INTERVAL '1 minute', ts)), COUNT(*) FROM ev "
        "UNION ALL SELECT 'window_1h', COUNT(DISTINCT time_bucket(INTERVAL '1 hour', ts)), COUNT(*) FROM ev "
        "UNION ALL SELECT 'large_balances', COUNT(*), COUNT(*) FROM ev WHERE balance > 50",
        _EV,
    ),
)(_dashboard)

# ---------------------------------------------------------------- 2.10 / 2.11 Spark ML (rows-only checks)
from callcast.functions.exprs import logit  # noqa: E402
from callcast.plans import ml as ML  # noqa: E402

_FB_COLS = [
    "previously_contacted", "days_since_previous_contact", "signed_log_balance", "log_campaign", "log_previous",
    "contact_intensity", "log_contact_intensity", "month_sin", "month_cos", "day_sin", "day_cos",
    "previous_campaign_success", "contact_channel_known",
]


def _feature_builder(spark, sf):
    out = ML.FeatureBuilder().transform(contacts(spark, sf))
    dbl = {c for c, t in out.dtypes if t == "double"}
    return out.select("contact_id", *[_F.round(c, 9).alias(c) if c in dbl else _F.col(c) for c in _FB_COLS])


register(
    "feature_builder",
    W(
        "SELECT contact_id, CASE WHEN pdays = -1 THEN 'no' ELSE 'yes' END AS previously_contacted, "
        "ROUND(CASE WHEN pdays >= 0 THEN pdays::DOUBLE END, 9) AS days_since_previous_contact, "
        "ROUND(sign(balance::DOUBLE) * ln(1 + abs(balance::DOUBLE)), 9) AS signed_log_balance, "
        "ROUND(ln(1 + campaign::DOUBLE), 9) AS log_campaign, ROUND(ln(1 + previous::DOUBLE), 9) AS log_previous, "
        "campaign + previous AS contact_intensity, ROUND(ln(1 + (campaign + previous)::DOUBLE), 9) AS log_contact_intensity, "
        f"ROUND(sin(2 * pi() * ({MONTH_NUM}) / 12), 9) AS month_sin, ROUND(cos(2 * pi() * ({MONTH_NUM}) / 12), 9) AS month_cos, "
        "ROUND(sin(2 * pi() * day / 31), 9) AS day_sin, ROUND(cos(2 * pi() * day / 31), 9) AS day_cos, "
        "CAST(poutcome = 'success' AS INTEGER) AS previous_campaign_success, CAST(contact <> 'unknown' AS INTEGER) AS contact_channel_known "
        "FROM contacts"
    ),
)(_feature_builder)


def _train_test(spark, sf):
    """80/20 md5 split (stands in for randomSplit, independent of partitioning)."""
    c = ML.with_label(contacts(spark, sf))
    return SP.hash_split(c, 0.8), SP.hash_split(c, 0.8, complement=True)


register("clip_bounds")(
    lambda spark, sf: ML.OutlierClipper().fit(contacts(spark, sf)).bounds(spark)
)




def _clip_ranks(spark, sf):
    """Are the learnt bounds within the sketch's rank error of the 1 % and 99 % ranks, and are all values inside them after clipping?"""
    c = contacts(spark, sf)
    model = ML.OutlierClipper().fit(c)
    err = ML.sketch_rank_error(ML.CLIP_SKETCH)
    clipped = model.transform(c)
    out = None
    for x, lo, hi in model.bounds(spark).collect():  # one row per column
        v = _F.col(x).cast("double")
        inside = lambda b, q: (_F.avg((v < b).cast("int")) <= q + err) & (_F.avg((v <= b).cast("int")) >= q - err)  # noqa: E731, B023
        ranks = c.agg(_F.lit(x).alias("column_name"), inside(lo, 0.01).alias("lower_rank_ok"), inside(hi, 0.99).alias("upper_rank_ok"))
        part = ranks.join(clipped.agg(_F.lit(x).alias("column_name"), ((_F.min(x) >= lo) & (_F.max(x) <= hi)).alias("clipped")), "column_name")
        out = part if out is None else out.unionByName(part)
    return out


register(
    "clip_bounds_ranks",
    W(" UNION ALL ".join(f"SELECT '{x}' AS column_name, COUNT(*) > 0 AS lower_rank_ok, COUNT(*) > 0 AS upper_rank_ok, COUNT(*) > 0 AS clipped FROM contacts" for x in ML.NUMERIC_COLUMNS)),
)(_clip_ranks)

_FITTED: dict = {}


def _fitted(spark, sf, kind: str, **kw):
    """A pipeline fitted on the 80% md5 training split, once per session and settings."""
    key = (spark.sparkContext.applicationId, sf, kind, tuple(sorted(kw.items())))
    if key not in _FITTED:
        train, _ = _train_test(spark, sf)
        _FITTED[key] = ML.build_pipeline(kind, **kw).fit(train)
    return _FITTED[key]


def _baseline_metrics(spark, sf):
    _, test = _train_test(spark, sf)
    frames = [ML.six_metrics(_fitted(spark, sf, kind).transform(test), kind) for kind in ("logistic", "tree")]
    return frames[0].unionByName(frames[1])


register("ml_baseline_metrics")(_baseline_metrics)


def _tuned(spark, sf):
    train, test = _train_test(spark, sf)
    train = SP.kfold_assign(train, k=ML.CV_FOLDS, seeds=(ML.SEED,))
    _, best = ML.tuned_logistic(train, fold_col=f"fold_{ML.SEED}")
    return best, test


register("ml_tuned_lr_metrics")(lambda spark, sf: (lambda m, t: ML.six_metrics(m.transform(t), "tuned_logistic"))(*_tuned(spark, sf)))


def _tree_importance(spark, sf):
    train, _ = _train_test(spark, sf)
    model = _fitted(spark, sf, "tree")
    pairs = ML.feature_importance(model, model.transform(train).schema)
    return spark.createDataFrame(pairs, "feature_name string, importance double")


register("tree_feature_importance")(_tree_importance)


def _predictions(spark, sf):
    _, test = _train_test(spark, sf)
    return ML.positive_probability(_fitted(spark, sf, "logistic").transform(test)).select("contact_id", "label", "prediction", "p")


register("predictions")(_predictions)
register("confusion_counts")(
    lambda spark, sf: ML.confusion_counts(_fitted(spark, sf, "logistic", maxIter=ML.LR_MAX_ITER_STREAM).transform(_train_test(spark, sf)[1]))
)


_FOLDED: dict = {}


def _folded_contacts(spark, sf):
    """All contacts with folds (seeds 42, 43), materialised once."""
    from callcast.session import materialize

    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOLDED:
        _FOLDED[key] = materialize(SP.kfold_assign(ML.with_label(contacts(spark, sf)), k=5, seeds=(42, 43)), "contact-folds")
    return _FOLDED[key]


_OOF: dict = {}


def _oof(spark, sf):
    """(contact_id, fold, label, p): out-of-fold probabilities of the class-weighted logistic regression."""
    from callcast.learn import design as D
    from callcast.learn import strategy as S

    key = (spark.sparkContext.applicationId, sf)
    if key not in _OOF:
        ready = S.prepare(_folded_contacts(spark, sf), _PRE_CALL_NUM, ML.CATEGORICAL_COLUMNS, ["fold_43"])
        scores = S.fold_scores([S.Family("logistic", "logistic", ((0.2,),))], ready, [D.Fit(str(v), ((0, v),)) for v in range(5)])
        _OOF[key] = scores.select(_F.col("id").alias("contact_id"), _F.col("fit").alias("fold"), "label", "p")
    return _OOF[key]


register("oof_predictions")(_oof)
# What of the out-of-fold frame does not depend on the fit: one row per contact, its fold and label, a probability.
register(
    "oof_coverage",
    W(
        "SELECT contact_id, CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY " + _MD5.format(seed=43) + ", contact_id) - 1) % 5 AS INTEGER) AS fold, "
        "CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS is_probability FROM contacts"
    ),
)(lambda spark, sf: _oof(spark, sf).select("contact_id", "fold", "label", _F.col("p").between(0, 1).alias("is_probability")))


# The prior baseline on its own: a constant score has an average precision equal to the fold's positive rate.
register(
    "prior_baseline",
    W(
        "SELECT fold, COUNT(*) AS rows, ROUND(AVG(label), 10) AS average_precision FROM (SELECT CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END AS label, "
        "CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY " + _MD5.format(seed=42) + ", contact_id) - 1) % 5 AS INTEGER) AS fold FROM contacts) GROUP BY fold"
    ),
)(lambda spark, sf: _folded_contacts(spark, sf).groupBy(_F.col("fold_42").alias("fold")).agg(_F.count(_F.lit(1)).alias("rows"), _F.round(_F.avg("label"), 10).alias("average_precision")))
register("logit", W("SELECT contact_id, ROUND(ln(greatest(p, 1e-6) / (1 - greatest(p, 1e-6))), 9) AS logit FROM scored", _SCORED))(
    lambda spark, sf: _scored(spark, sf).select("contact_id", _F.round(logit("p"), 9).alias("logit"))
)
# The columns of ``predictions`` that do not depend on the fit.
register(
    "prediction_rows",
    W("SELECT contact_id, CASE WHEN y = 'yes' THEN 1.0 ELSE 0.0 END::DOUBLE AS label, true AS consistent FROM contacts WHERE substr(" + _MD5.format(seed=42) + ", 1, 8) >= 'cccccccc'"),
)(lambda spark, sf: _predictions(spark, sf).select("contact_id", "label", ((_F.col("p") > 0.5) == (_F.col("prediction") == 1.0)).alias("consistent")))


def _stream_predict(spark, sf):
    c = ML.with_label(contacts(spark, sf))
    model = ML.build_pipeline("logistic", maxIter=ML.LR_MAX_ITER_STREAM).fit(c)
    orders = table(spark, sf, "orders")
    orders = orders.select(_F.col("o_orderkey").alias("contact_id"), SJ.ntz_as_utc("o_orderdate", orders).alias("event_time"))
    hist = c.join(orders, "contact_id").drop("label")
    key = (spark.sparkContext.applicationId, sf, "contacts")
    if key not in _REPLAYS:
        _REPLAYS[key] = SJ.write_replay(hist, "event_time", "contacts-replay")
    stream = SJ.file_stream(spark, _REPLAYS[key], hist.schema)
    scored_stream = SJ.stream_predict(model, stream.withColumn("label", _F.when(_F.col("y") == "yes", 1.0).otherwise(0.0)),
                                      keep=("contact_id", "event_time", "age", "job", "balance", "duration", "y"))
    return SJ.drain(scored_stream, "append", sink="parquet")[0]


register("stream_predict")(_stream_predict)

# ---------------------------------------------------------------- calibration, ablation, importance, bootstrap
_PRE_CALL_NUM = [x for x in ML.NUMERIC_COLUMNS if x != "duration"]


def _pre_call_pipeline(kind: str, **kw):
    return ML.build_pipeline(kind, numeric=_PRE_CALL_NUM, clip=False, features=True, impute=True, **kw)


_SPLITS: dict = {}


def _dev_test(spark, sf):
    """Development (train + validation) and test parts, materialised once per session:
    the many model fits below then read Parquet instead of replaying the split lineage.

    Every assignment shuffles whole rows; each is written alone, so that the shuffle files of one are there at a time."""
    from callcast.session import discard, written

    key = (spark.sparkContext.applicationId, sf)
    if key not in _SPLITS:
        s, path = written(SP.stratified_split(ML.with_label(contacts(spark, sf))), "dev-test")
        for seed in (43, 44):
            discard(spark)
            old, (s, path) = path, written(SP.kfold_assign(s, k=5, seeds=(seed,)), "dev-test")
            discard(spark, old)
        _SPLITS[key] = (s.where(_F.col("split") != "test").drop("split"), s.where(_F.col("split") == "test").drop("split", "fold_43", "fold_44"))
    return _SPLITS[key]


# ---------------------------------------------------------------- 2.13 partitioning (result unchanged)
from callcast.session import env_int  # noqa: E402


def _partitioned_avg(spark, sf):
    """Parallel module: partial sums dealt out by job, twice as many partitions as cores; same result as without."""
    cores = env_int("CALLCAST_CORES", spark.sparkContext.defaultParallelism)
    from callcast.session import described

    with described(spark, "Average balance by job, partitioned"):
        return R.avg_balance_by_job_partitioned(contacts(spark, sf), max(4, 2 * cores))


register("avg_balance_by_job_partitioned", W("SELECT job, AVG(balance) AS average_balance FROM contacts GROUP BY job"))(_partitioned_avg)

# ---------------------------------------------------------------- CSV sources over derived data
from callcast.sources.strict import scan_strict  # noqa: E402
from callcast.sources.tables import scan_contacts  # noqa: E402

_CSV: dict = {}
_BANK_COLS = ALL_COLS.replace("contact_id, ", "")


def _contacts_csv(spark, sf):
    """The contacts table written as one header CSV folder (17 columns, file layout)."""
    from callcast.schema import CONTACT_COLUMNS
    from callcast.session import scratch_path

    key = (spark.sparkContext.applicationId, sf)
    if key not in _CSV:
        path = scratch_path(spark, "contacts-csv")
        contacts(spark, sf).select(*CONTACT_COLUMNS).write.option("header", True).csv(path)
        _CSV[key] = path
    return _CSV[key]


register("scan_contacts_csv", W(f"SELECT {_BANK_COLS} FROM contacts"))(
    lambda spark, sf: scan_contacts(spark, _contacts_csv(spark, sf), with_id=False)
)
register("scan_strict_csv", W(f"SELECT {_BANK_COLS} FROM contacts"))(
    lambda spark, sf: scan_strict(spark, _contacts_csv(spark, sf))[0]
)


def _eda_summary(spark, sf):
    """Headline values (correlation, busiest month, best channel) as one row."""
    c = contacts(spark, sf)
    corr_v = ST.corr(c).first()[0]
    m = R.month_contact_summary(c).orderBy(_F.col("contact_count").desc(), "month").first()
    b = R.best_contact_method(c).first()
    return spark.createDataFrame(
        [(corr_v, m["month"], int(m["contact_count"]), round(float(m["success_rate"]), 6), b["contact"], round(float(b["success_rate"]), 6))],
        "age_balance_correlation double, highest_contact_month string, contact_count long, month_success_rate double, "
        "best_contact_method string, contact_success_rate double",
    )


register(
    "eda_summary",
    W(
        "SELECT (SELECT ROUND(corr(age::DOUBLE, balance::DOUBLE), 10) FROM contacts) AS age_balance_correlation, "
        "m.month AS highest_contact_month, m.contact_count, ROUND(m.success_rate, 6) AS month_success_rate, "
        "b.contact AS best_contact_method, ROUND(b.success_rate, 6) AS contact_success_rate FROM "
        f"(SELECT month, COUNT(*) AS contact_count, AVG({YES}) * 100 AS success_rate FROM contacts GROUP BY month "
        "ORDER BY contact_count DESC, month LIMIT 1) m, "
        f"(SELECT contact, AVG({YES}) * 100 AS success_rate FROM contacts GROUP BY contact ORDER BY success_rate DESC, contact LIMIT 1) b"
    ),
)(_eda_summary)


# ---------------------------------------------------------------- comparison, calibration, frozen strategy
from callcast.plans import strategy_queries  # noqa: E402, F401
