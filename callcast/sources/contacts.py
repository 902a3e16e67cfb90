"""The ``contacts`` table: one contact row per order, derived from the driver tables.

Rules (same as FIXTURES.md section 4):

* orders JOIN customer JOIN nation JOIN region, LEFT JOIN per-order lineitem
  totals (count, quantity, revenue);
* "previous" = the customer's previous order by (o_orderdate, o_orderkey).

Plan shape, chosen for scale:

* lineitem is pre-aggregated per order before any join (partial + final hash
  aggregate; the join then sees one row per order);
* nation x region is joined first and broadcast behind a size check
  (25 rows in TPC-H; the check keeps it honest for other inputs);
* the per-customer previous order comes from ``ordered.running`` (range
  partitioning), not from ``Window.partitionBy(o_custkey)``: a customer with a
  third of all orders is spread over many tasks;
* customer is joined by key (AQE picks broadcast when small, shuffle with
  skew-join splitting when not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcast.functions.exprs import MONTHS
from callcast.operators.ordered import running
from callcast.session import disposable, written
from callcast.sources.tables import table

# Fixed values of the derivation rules.
REVENUE_YES = 350000
AGE_BASE, AGE_MOD = 18, 73
DEFAULT_BELOW = -500
LOAN_RANGE = (0, 1500)
EDUCATION_BY_REGION = {"AFRICA": "unknown", "AMERICA": "primary", "EUROPE": "tertiary"}  # else secondary
MARITAL_BY_MOD3 = ["married", "single", "divorced"]
CONTACT_BY_PRIORITY = {"1-URGENT": "cellular", "2-HIGH": "cellular", "3-MEDIUM": "telephone"}  # else unknown
POUTCOME_BY_STATUS = {"F": "failure", "O": "other", "P": "success"}  # none -> unknown
# End of fixed values.

_CACHE: dict[tuple[int, str], DataFrame] = {}


def _case(col, mapping: dict, default: str):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def build_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lazy plan of the contacts table (18 columns, ``contact_id`` first)."""
    li = table(spark, sf_dir, "lineitem")
    totals = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )

    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    hist = running(orders, keys=["o_custkey"], order=["o_orderdate", "o_orderkey"], lags=["o_orderdate", "o_orderstatus"])

    geo = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    cust = cust.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))

    joined = (
        hist.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )

    month_num = F.month("o_orderdate")
    month_label = None
    for i, m in enumerate(MONTHS, start=1):
        month_label = F.when(month_num == i, m) if month_label is None else month_label.when(month_num == i, m)
    marital = None
    for i, m in enumerate(MARITAL_BY_MOD3):
        cond = (F.col("n_nationkey") % 3) == i
        marital = F.when(cond, m) if marital is None else marital.when(cond, m)
    bal = F.col("c_acctbal")
    return joined.select(
        F.col("o_orderkey").alias("contact_id"),
        (F.lit(AGE_BASE) + F.col("c_custkey") % AGE_MOD).cast("int").alias("age"),
        F.lower("c_mktsegment").alias("job"),
        marital.alias("marital"),
        _case(F.col("r_name"), EDUCATION_BY_REGION, "secondary").alias("education"),
        F.when(bal < DEFAULT_BELOW, "yes").otherwise("no").alias("default"),
        F.floor(bal).cast("int").alias("balance"),
        F.when(F.col("c_custkey") % 2 == 0, "yes").otherwise("no").alias("housing"),
        F.when((bal >= LOAN_RANGE[0]) & (bal < LOAN_RANGE[1]), "yes").otherwise("no").alias("loan"),
        _case(F.col("o_orderpriority"), CONTACT_BY_PRIORITY, "unknown").alias("contact"),
        F.dayofmonth("o_orderdate").cast("int").alias("day"),
        month_label.alias("month"),
        F.coalesce(F.col("qty"), F.lit(0.0)).cast("int").alias("duration"),
        F.coalesce(F.col("n_lines"), F.lit(1)).cast("int").alias("campaign"),
        F.when(F.col("prev_o_orderdate").isNull(), F.lit(-1))
        .otherwise(F.datediff(F.col("o_orderdate"), F.col("prev_o_orderdate")))
        .cast("int")
        .alias("pdays"),
        (F.col("row_number") - 1).cast("int").alias("previous"),
        _case(F.col("prev_o_orderstatus"), POUTCOME_BY_STATUS, "unknown").alias("poutcome"),
        F.when(F.coalesce(F.col("revenue"), F.lit(0.0)) >= REVENUE_YES, "yes").otherwise("no").alias("y"),
    )


def contacts(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """The contacts table for ``sf_dir``.

    With ``materialized`` (default) it is built once per session and data
    folder, written as Parquet under ``spark.checkpoint.dir`` and read back:
    every report then scans a narrow columnar table with pushdown instead of
    re-running the joins, and lineage is cut.
    """
    if not materialized:
        return build_contacts(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        with disposable(spark):
            _CACHE[key] = written(build_contacts(spark, sf_dir), "contacts")[0]
    return _CACHE[key]
