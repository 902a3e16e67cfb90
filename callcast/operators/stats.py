"""Correlation and hypothesis tests as Spark aggregates.

Every test reduces the rows to small sufficient statistics on the executors
(moments, a contingency table, value-grouped counts); only those leave Spark.
Tail probabilities are computed from the aggregated statistic with the
standard formulas (no scipy here).
"""

from __future__ import annotations

import math
from itertools import combinations
from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcast.operators.ordered import running_counts
from callcast.operators.quantiles import exact_percentiles

CORR_COLUMNS = ("age", "balance", "day", "duration", "campaign", "pdays", "previous")


def corr(df: DataFrame, a: str = "age", b: str = "balance", digits: int = 10) -> DataFrame:
    """Pearson correlation in one aggregate."""
    return df.agg(F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), digits).alias(f"{a}_{b}_correlation"))


def corr_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLUMNS, target: str | None = "y", digits: int = 9) -> DataFrame:
    """Long-form Pearson matrix (a, b, corr) of ``cols`` plus a 0/1 ``subscribed``.

    Two passes whatever the column count: the means (one aggregate, read as
    literals), then one aggregate of centered cross products (plain sums,
    codegen-friendly and numerically stable).  When a column holds NULLs the
    pairwise-complete ``corr`` aggregate is used instead.  Diagonal is 1.
    """
    frame = df.select(*[F.col(c).cast("double").alias(c) for c in cols], *(
        [F.when(F.col(target) == "yes", 1.0).otherwise(0.0).alias("subscribed")] if target else []
    ))
    names = list(cols) + (["subscribed"] if target else [])
    pairs = list(combinations(names, 2))
    first = frame.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"m_{c}") for c in names],
                      *[F.count(c).alias(f"c_{c}") for c in names]).first()
    if all(first[f"c_{c}"] == first["_n"] for c in names):
        d = {c: F.col(c) - F.lit(first[f"m_{c}"]) for c in names}
        sums = frame.agg(*[F.sum(d[c] * d[c]).alias(f"ss_{c}") for c in names],
                         *[F.sum(d[a] * d[b]).alias(f"{a}|{b}") for a, b in pairs])
        value = lambda a, b: F.col(f"`{a}|{b}`") / F.sqrt(F.col(f"ss_{a}") * F.col(f"ss_{b}"))
        wide = sums
    else:
        wide = frame.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
        value = lambda a, b: F.col(f"`{a}|{b}`")
    cells = []
    for a, b in pairs:
        v = F.round(value(a, b), digits)
        cells += [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("corr")),
                  F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), v.alias("corr"))]
    cells += [F.struct(F.lit(n).alias("a"), F.lit(n).alias("b"), F.lit(1.0).alias("corr")) for n in names]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ---------------------------------------------------------------- tail probabilities
def chi2_sf(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable with an integer number of degrees of freedom.

    A finite sum: with h = x/2, even dof give exp(-h) * sum h^i/i! for i < dof/2;
    odd dof give erfc(sqrt(h)) plus exp(-h) * sum h^(i+1/2)/Gamma(i+3/2).
    """
    if dof <= 0 or x != x:
        return float("nan")
    if x <= 0:
        return 1.0
    h, odd = x / 2.0, dof % 2
    steps = [math.exp(-h + (i + odd / 2.0) * math.log(h) - math.lgamma(i + 1 + odd / 2.0)) for i in range((dof - odd) // 2)]
    return min(1.0, math.fsum(steps) + (math.erfc(math.sqrt(h)) if odd else 0.0))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _tail(value: Callable[..., float], *cols: str) -> Column:
    """A tail probability as a column, for a frame of one row."""

    def apply(*series: pd.Series) -> pd.Series:
        return pd.Series([None if any(pd.isna(x) for x in row) else value(*row) for row in zip(*series)], dtype="float64")

    apply.__annotations__ = {"series": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, "double")(*[F.col(c) for c in cols])


# ---------------------------------------------------------------- chi-square
def chi_square(df: DataFrame, a: str = "contact", b: str = "y", yates: bool = True, digits: int = 10) -> DataFrame:
    """Pearson chi-square of the (a, b) contingency table.

    One row: chi2, dof, cramers_v, n, p_value, reject_h0 (p < 0.05).  With cells
    o, margins r and c and total n, chi2 = n * (sum of o^2 / (r c) - 1), so empty
    cells need no row and any number of levels will do.  Like scipy, the Yates
    correction applies only when dof = 1; there all cells are off by the same
    d = |o - e|, and sum of 1/e comes from the margins.  NULL is a level.
    """
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("o"))
    rows = cells.groupBy(F.col("a").alias("_a")).agg(F.sum("o").alias("r"))
    cols = cells.groupBy(F.col("b").alias("_b")).agg(F.sum("o").alias("c"))
    shares = cells.join(rows, F.col("a").eqNullSafe(F.col("_a"))).join(cols, F.col("b").eqNullSafe(F.col("_b")))
    nil = F.lit(0.0)
    parts = (
        shares.select(F.col("o").alias("n"), (F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("s"), nil.alias("ir"), nil.alias("ic"), nil.alias("nr"), nil.alias("nc"))
        .unionByName(rows.select(nil.alias("n"), nil.alias("s"), (1 / F.col("r")).alias("ir"), nil.alias("ic"), F.lit(1.0).alias("nr"), nil.alias("nc")))
        .unionByName(cols.select(nil.alias("n"), nil.alias("s"), nil.alias("ir"), (1 / F.col("c")).alias("ic"), nil.alias("nr"), F.lit(1.0).alias("nc")))
    )
    t = parts.agg(*[F.sum(x).alias(x) for x in ("n", "s", "ir", "ic", "nr", "nc")])
    plain = F.greatest(F.lit(0.0), F.col("n") * (F.col("s") - 1))
    inverse = F.col("n") * F.col("ir") * F.col("ic")
    off = F.sqrt(plain / inverse)
    dof = ((F.col("nr") - 1) * (F.col("nc") - 1)).cast("int")
    chi2 = F.when((dof == 1) & F.lit(yates), F.pow(off - F.least(F.lit(0.5), off), 2) * inverse).otherwise(plain)
    out = t.select(
        F.round(chi2, digits).alias("chi2"),
        dof.alias("dof"),
        F.round(F.sqrt(chi2 / (F.col("n") * (F.least("nr", "nc") - 1))), digits).alias("cramers_v"),
        F.col("n").cast("long").alias("n"),
    )
    return out.withColumn("p_value", _tail(chi2_sf, "chi2", "dof")).withColumn("reject_h0", F.coalesce(F.col("p_value") < 0.05, F.lit(False)))


# ---------------------------------------------------------------- Mann-Whitney U
def mann_whitney(df: DataFrame, x: str = "balance", group: str = "y", positive: str = "yes", digits: int = 10) -> DataFrame:
    """Two-sided Mann-Whitney U of the ``positive`` group against the rest.

    U (of the positive group) = sum over distinct values v of
    n_pos(v) * (n_neg below v + n_neg(v) / 2), from value-grouped counts and a
    prefix sum (``ordered.running_counts``); ties term sum(t^3 - t) from the same
    counts.  p from the tie- and continuity-corrected normal approximation.
    Also both medians (exact) and the rank-biserial effect 2U/(n1 n2) - 1.
    """
    is_pos = (F.col(group) == positive)
    g = (
        df.where(F.col(x).isNotNull())
        .groupBy(F.col(x).cast("double").alias("v"))
        .agg(F.sum(is_pos.cast("long")).alias("n1v"), F.sum((~is_pos).cast("long")).alias("n0v"))
    )
    r = running_counts(g, [], ["v"], ["n0v"])
    s = r.agg(
        F.sum("n1v").alias("n1"),
        F.sum("n0v").alias("n0"),
        F.sum(F.col("n1v") * (F.col("cum_n0v") - F.col("n0v") / 2.0)).alias("u"),
        F.sum(F.pow(F.col("n1v") + F.col("n0v"), 3) - (F.col("n1v") + F.col("n0v"))).alias("ties"),
    )
    halves = exact_percentiles(df.select(F.col(x).alias("v"), is_pos.alias("pos")), ["v"], (0.5,), by=["pos"])
    med = {r["pos"]: r["q0"] for r in halves.collect()}  # two rows
    n1, n0, n = F.col("n1").cast("double"), F.col("n0").cast("double"), (F.col("n1") + F.col("n0")).cast("double")
    mu = n1 * n0 / 2
    sigma = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    u_big = F.greatest(F.col("u"), n1 * n0 - F.col("u"))
    z = (u_big - mu - 0.5) / sigma
    return s.select(
        F.col("n1").cast("long").alias("n_positive"),
        F.col("n0").cast("long").alias("n_other"),
        F.lit(med.get(True)).cast("double").alias("median_positive"),
        F.lit(med.get(False)).cast("double").alias("median_other"),
        F.round("u", digits).alias("u_statistic"),
        F.round(2 * F.col("u") / (n1 * n0) - 1, digits).alias("rank_biserial"),
        F.round(z, digits).alias("z"),
    ).withColumn("p_value", _tail(normal_two_sided, "z"))
