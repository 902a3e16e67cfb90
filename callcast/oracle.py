"""DuckDB SQL used as an independent oracle for the Spark jobs.

Each string runs on DuckDB with the driver tables registered as views.
``with_contacts`` prefixes the ``contacts`` derivation as CTEs, so every
oracle query is self-contained.
"""

from __future__ import annotations

CONTACTS_CTES = """
cc_li AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS qty,
         SUM(l_extendedprice * (1 - l_discount)) AS revenue
  FROM lineitem GROUP BY l_orderkey
),
cc_o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         ROW_NUMBER() OVER w AS rn,
         LAG(o_orderdate) OVER w AS prev_date,
         LAG(o_orderstatus) OVER w AS prev_status
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
contacts AS (
  SELECT
    o.o_orderkey AS contact_id,
    CAST(18 + c.c_custkey % 73 AS INTEGER) AS age,
    lower(c.c_mktsegment) AS job,
    CASE n.n_nationkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE 'divorced' END AS marital,
    CASE r.r_name WHEN 'AFRICA' THEN 'unknown' WHEN 'AMERICA' THEN 'primary'
                  WHEN 'EUROPE' THEN 'tertiary' ELSE 'secondary' END AS education,
    CASE WHEN c.c_acctbal < -500 THEN 'yes' ELSE 'no' END AS "default",
    CAST(floor(c.c_acctbal) AS INTEGER) AS balance,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN c.c_acctbal >= 0 AND c.c_acctbal < 1500 THEN 'yes' ELSE 'no' END AS loan,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'cellular'
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'telephone' ELSE 'unknown' END AS contact,
    CAST(day(o.o_orderdate) AS INTEGER) AS day,
    CASE month(o.o_orderdate) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mar' WHEN 4 THEN 'apr'
         WHEN 5 THEN 'may' WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug' WHEN 9 THEN 'sep'
         WHEN 10 THEN 'oct' WHEN 11 THEN 'nov' WHEN 12 THEN 'dec' END AS month,
    CAST(coalesce(li.qty, 0) AS INTEGER) AS duration,
    CAST(coalesce(li.n_lines, 1) AS INTEGER) AS campaign,
    CAST(CASE WHEN o.prev_date IS NULL THEN -1
              ELSE date_diff('day', o.prev_date, o.o_orderdate) END AS INTEGER) AS pdays,
    CAST(o.rn - 1 AS INTEGER) AS previous,
    CASE o.prev_status WHEN 'F' THEN 'failure' WHEN 'O' THEN 'other' WHEN 'P' THEN 'success'
         ELSE 'unknown' END AS poutcome,
    CASE WHEN coalesce(li.revenue, 0) >= 350000 THEN 'yes' ELSE 'no' END AS y
  FROM cc_o o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN cc_li li ON li.l_orderkey = o.o_orderkey
)"""


def with_contacts(body: str, ctes: str = "") -> str:
    """``WITH <contacts>[, ctes] <body>``."""
    extra = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {CONTACTS_CTES.strip()}{extra}\n{body.strip()}"
