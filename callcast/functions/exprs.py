"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels in calendar order, numbered 1..12.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
# Campaign bins (right-closed) and their labels.
CAMPAIGN_EDGES = [0, 1, 2, 3, 5, 10, math.inf]
CAMPAIGN_LABELS = ["1", "2", "3", "4-5", "6-10", "11+"]
# Age bins (right-closed) for the EDA and the audit forms.
AGE_EDGES_EDA = [17, 29, 39, 49, 59, 100]
AGE_EDGES_AUDIT = [17, 29, 39, 49, 59, math.inf]
AGE_LABELS = ["18-29", "30-39", "40-49", "50-59", "60+"]
# End of fixed values.


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_order(col: str | Column = "month", default: int | None = 99) -> Column:
    """Calendar number of a lower-case month label; ``default`` otherwise.

    The reference uses 99 in Spark, 13 in HiveQL and NULL in pandas.
    """
    place = F.array_position(F.lit(MONTHS), _col(col))  # 0 if it is no month
    return F.when(place > 0, place.cast("int")).otherwise(F.lit(default))


def quarter(col: str | Column = "month") -> Column:
    """Q1..Q4 from the month label; unknown months fall into Q4."""
    number = F.least(F.ceil(month_order(col, 12) / 3), F.lit(4))
    return F.concat(F.lit("Q"), number.cast("string"))


def age_group3(col: str | Column = "age", null_safe: bool = False) -> Column:
    """``<30`` / ``30-60`` / ``>60`` (60 belongs to the middle group).

    NULL age falls to ``>60`` like the reference unless ``null_safe``.
    """
    a = _col(col)
    expr = F.when(a < 30, "<30").when((a >= 30) & (a <= 60), "30-60")
    if null_safe:
        expr = expr.when(a.isNull(), F.lit(None))
    return expr.otherwise(">60")


def age_band5(col: str | Column = "age", null_safe: bool = False) -> Column:
    """Decade bands ``18-29 .. 60+`` (60 belongs to ``60+``)."""
    band = bucketize_left(col, [30, 40, 50, 60], AGE_LABELS)
    return F.when(_col(col).isNotNull(), band) if null_safe else F.coalesce(F.when(_col(col).isNotNull(), band), F.lit(AGE_LABELS[-1]))


def bucketize_left(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bins below, between and above ``edges``: one label more than edges."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    above = sum((_col(col) >= F.lit(e)).cast("int") for e in edges)
    return F.get(F.lit(list(labels)), above)


def bucketize_right(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]`` with labels; NULL outside.

    ``Bucketizer`` is left-closed, hence this generated CASE chain.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = _col(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (x <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def age_bins(col: str | Column = "age", audit: bool = False) -> Column:
    return bucketize_right(col, AGE_EDGES_AUDIT if audit else AGE_EDGES_EDA, AGE_LABELS)


def campaign_group(col: str | Column = "campaign") -> Column:
    return bucketize_right(col, CAMPAIGN_EDGES, CAMPAIGN_LABELS)


def is_yes(col: str | Column = "y") -> Column:
    """1 when the value is ``yes`` else 0 (NULL counts as 0, as in CASE WHEN)."""
    return F.when(_col(col) == "yes", 1).otherwise(0)


def label(col: str | Column = "y") -> Column:
    """1.0 for ``yes``, 0.0 otherwise."""
    return F.when(_col(col) == "yes", 1.0).otherwise(0.0)


def strict_label(col: str | Column = "y") -> Column:
    """1.0/0.0 for yes/no; any other value fails the job."""
    c = _col(col)
    return (
        F.when(c == "yes", F.lit(1.0))
        .when(c == "no", F.lit(0.0))
        .otherwise(F.raise_error(F.concat(F.lit("unexpected label: "), F.coalesce(c, F.lit("NULL")))).cast("double"))
    )


def rate_pct(flag: Column) -> Column:
    """100 * mean of a 0/1 flag."""
    return F.avg(flag) * 100


def signed_log(col: str | Column) -> Column:
    c = _col(col).cast("double")
    return F.signum(c) * F.log1p(F.abs(c))


def logit(col: str | Column, eps: float = 1e-6) -> Column:
    p = F.least(F.greatest(_col(col).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    return F.log(p / (F.lit(1.0) - p))


def to_class(prob: str | Column, threshold: float) -> Column:
    return (_col(prob) >= F.lit(threshold)).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or NULL."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def fmt2(col: str | Column) -> Column:
    """Fixed two-decimal text, for TSV/CSV sinks only."""
    return F.format_string("%.2f", _col(col))
