"""Exact interpolated percentiles without a buffer of all values in one task.

Values are counted (map-side combined), the counts get running totals through
``ordered.running_counts``, and a percentile is read off at the two neighbouring ranks.
Many columns and groups share one pass.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcast.operators.ordered import running_counts


def exact_percentiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """One row per (column_name, ``by``): n and q0, q1, ... for the shares ``qs``.

    NULL values are left out (a column or group without values has no row);
    a NULL group is a group.  Between two ranks the value is interpolated.
    """
    by = list(by)
    stacked = df.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    keys = ["column_name", *by]
    counts = stacked.select(*by, "s.column_name", "s.v").where("v IS NOT NULL").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_counts(counts, keys, ["v"], ["n"])
    sizes = ranked.groupBy(*keys).agg(F.max("cum_n").alias("_size"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    r = ranked.join(sizes.withColumnsRenamed({k: f"_k_{k}" for k in keys}), same)
    picks = []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("_size") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
            picks.append(F.max(F.when(here, F.col("v"))).alias(f"{side}{i}"))
    wide = r.groupBy(*keys).agg(F.max("_size").cast("long").alias("n"), *picks)
    out = []
    for i, q in enumerate(qs):
        at, lo, hi = F.lit(float(q)) * (F.col("n") - 1), F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(f"q{i}"))
    return wide.select(*keys, "n", *out)
