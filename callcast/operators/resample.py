"""Resampling on Spark: bootstrap intervals and column permutations.

Both are driven by hash-based uniforms of (row id, replicate, seed), so a
replicate is the same on any partitioning and after any task retry.

Bootstrap: the Poisson bootstrap (each row gets a Poisson(1) count per
replicate, the distributed form of resampling n rows with replacement).
Rows are dealt out once by score; a task keeps one running sum per replicate
for its rows and takes the sums of the ranges before it from a table with one
row per range.  Nothing grows with rows x replicates.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcast.operators.ordered import running
from callcast.session import materialize, ship_package

_U_BITS = 52


def hash_uniform(*cols: Column, seed: int = 42) -> Column:
    """Uniform [0, 1) from xxhash64 of the columns and the seed."""
    h = F.xxhash64(*cols, F.lit(seed))
    bits = F.shiftright(h, 64 - _U_BITS).bitwiseAND(F.lit((1 << _U_BITS) - 1))
    return bits.cast("double") / float(1 << _U_BITS)


def poisson_steps() -> list[float]:
    """The CDF of Poisson(1) at 0, 1, 2, ... up to where it is 1 in double precision."""
    cdf, term, k, steps = 0.0, math.exp(-1.0), 0, []
    while cdf + term > cdf:
        cdf += term
        steps.append(cdf)
        k += 1
        term /= k
    return steps


def poisson1(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF of the uniform ``u``."""
    steps = poisson_steps()
    expr = F.when(u < F.lit(steps[0]), F.lit(0))
    for k, bound in enumerate(steps[1:], start=1):
        expr = expr.when(u < F.lit(bound), F.lit(k))
    return expr.otherwise(F.lit(len(steps)))


def _counts(ids: np.ndarray, n_boot: int, seed: int) -> np.ndarray:
    """Poisson(1) counts, one row per id and one column per replicate, from a hash of (id, replicate, seed)."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        x = x + np.arange(1, n_boot + 1, dtype=np.uint64)[None, :] * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(seed)
        for mul in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x ^= x >> np.uint64(33)
            x *= np.uint64(mul)
        x ^= x >> np.uint64(33)
    return np.searchsorted(poisson_steps(), (x >> np.uint64(11)).astype(np.float64) * 2.0**-53, side="right").astype(np.float64)


_ROWS = 1024


def _range_sums(n_boot: int, seed: int):
    """Per range: the weighted positives and negatives of every replicate."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for pid, part in pdf.groupby("_pid"):
                own = sums.setdefault(int(pid), np.zeros((2, n_boot)))
                for a in range(0, len(part), _ROWS):
                    w, y = _counts(part["_id"].to_numpy()[a : a + _ROWS], n_boot, seed), part["y"].to_numpy()[a : a + _ROWS]
                    own[0] += y @ w
                    own[1] += (1 - y) @ w
        yield pd.DataFrame({"_pid": list(sums), "pos": [x[0].tolist() for x in sums.values()], "neg": [x[1].tolist() for x in sums.values()]})

    return run


def _range_metrics(carry, n_boot: int, seed: int, threshold: float):
    """Per range and replicate: the range's part of the average precision's numerator and of the hits at the threshold."""

    def run(batches):
        pid, score = None, None
        before, open_sums, ap, tp = np.zeros((2, n_boot)), np.zeros((2, n_boot)), np.zeros(n_boot), np.zeros(n_boot)

        def close(pos, neg, scores):
            """Take in whole groups of equal scores, in order: running sums over all of them at once."""
            nonlocal before, ap, tp
            cum_pos, cum_neg = before[0] + np.cumsum(pos, axis=0), before[1] + np.cumsum(neg, axis=0)
            with np.errstate(invalid="ignore", divide="ignore"):
                ap = ap + np.nan_to_num(pos * cum_pos / (cum_pos + cum_neg)).sum(axis=0)
            tp = tp + pos[scores >= threshold].sum(axis=0)
            before = np.stack([cum_pos[-1], cum_neg[-1]])

        def close_open():
            close(open_sums[:1], open_sums[1:], np.array([score]))

        for pdf in batches:
            for a in range(0, len(pdf), _ROWS):
                part = pdf.iloc[a : a + _ROWS]
                w, y, p, ids = _counts(part["_id"].to_numpy(), n_boot, seed), part["y"].to_numpy(), part["p"].to_numpy(), part["_pid"].to_numpy()
                starts = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (ids[1:] != ids[:-1])]))
                pos, neg = np.add.reduceat(w * y[:, None], starts), np.add.reduceat(w * (1 - y)[:, None], starts)
                scores, owner = p[starts], ids[starts]
                cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1), len(owner)]
                for lo, hi in zip(cuts[:-1], cuts[1:]):  # the ranges in this block: one, but at a border
                    if owner[lo] == pid and scores[lo] == score:  # the first group goes on
                        pos[lo] += open_sums[0]
                        neg[lo] += open_sums[1]
                    elif pid is not None:
                        close_open()
                    if owner[lo] != pid:
                        if pid is not None:
                            yield pd.DataFrame({"b": np.arange(n_boot), "ap_num": ap, "tp": tp})
                        pid, ap, tp = owner[lo], np.zeros(n_boot), np.zeros(n_boot)
                        before = carry.value.get(int(pid), np.zeros((2, n_boot)))
                    if hi - lo > 1:
                        close(pos[lo : hi - 1], neg[lo : hi - 1], scores[lo : hi - 1])
                    open_sums, score = np.stack([pos[hi - 1], neg[hi - 1]]), scores[hi - 1]
        if pid is not None:
            close_open()
            yield pd.DataFrame({"b": np.arange(n_boot), "ap_num": ap, "tp": tp})

    return run


def bootstrap_ci(
    df: DataFrame,
    threshold: float,
    n_boot: int = 1000,
    seed: int = 42,
    p: str = "p",
    label: str = "label",
    id_col: str = "contact_id",
    level: float = 0.95,
) -> DataFrame:
    """95% intervals of PR-AUC (average precision) and recall at ``threshold``.

    Replicates whose sample holds one class only are skipped (as the
    reference does).  Returns (metric, lower_95, upper_95, replicates).
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(p).cast("double").alias("p"), F.col(label).cast("double").alias("y"), F.col(id_col).cast("long").alias("_id"), (-F.col(p).cast("double")).alias("_neg"))
    cut = materialize(rows.where("p IS NOT NULL AND y IS NOT NULL").repartitionByRange("_neg").withColumn("_pid", F.spark_partition_id()), "bootstrap")
    ranges = cut.select("_pid", "_id", "y").mapInPandas(_range_sums(n_boot, seed), "_pid int, pos array<double>, neg array<double>")
    total = np.zeros((2, n_boot))
    sums: dict[int, np.ndarray] = {}
    for r in ranges.collect():  # a row per task and range, each with 2 * n_boot numbers
        sums[r["_pid"]] = sums.get(r["_pid"], 0) + np.array([r["pos"], r["neg"]])
    carry = {}
    for pid in sorted(sums):
        carry[pid] = total
        total = total + sums[pid]
    dealt = cut.repartition("_pid").sortWithinPartitions("_pid", "_neg", "_id")
    parts = dealt.mapInPandas(_range_metrics(spark.sparkContext.broadcast(carry), n_boot, seed, threshold), "b int, ap_num double, tp double")
    wholes = spark.createDataFrame([(b, float(total[0, b])) for b in range(n_boot) if total[0, b] > 0 and total[1, b] > 0], "b int, P double")
    per_rep = parts.groupBy("b").agg(F.sum("ap_num").alias("ap_num"), F.sum("tp").alias("tp")).join(wholes, "b")
    per_rep = per_rep.select("b", F.round(F.col("ap_num") / F.col("P"), 12).alias("pr_auc"), F.round(F.col("tp") / F.col("P"), 12).alias("recall"))
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    q = per_rep.agg(  # over n_boot rows
        F.count(F.lit(1)).alias("replicates"),
        F.percentile("pr_auc", [lo, hi]).alias("a"),
        F.percentile("recall", [lo, hi]).alias("r"),
    )
    rows = [
        F.struct(F.lit("PR-AUC").alias("metric"), F.col("a")[0].alias("lower_95"), F.col("a")[1].alias("upper_95"), F.col("replicates")),
        F.struct(F.lit("Recall").alias("metric"), F.col("r")[0].alias("lower_95"), F.col("r")[1].alias("upper_95"), F.col("replicates")),
    ]
    return q.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def permute_columns(
    df: DataFrame,
    features: Sequence[str],
    repeats: int = 10,
    seed: int = 42,
    id_col: str = "contact_id",
) -> DataFrame:
    """All (feature, repeat) permutations stacked in one frame.

    For permutation (f, r), row i takes column f from the row whose rank by
    hash(id, f, r) equals i's rank by id; every other column is i's own.
    Output: the input columns plus ``perm_feature`` and ``perm_repeat``.
    Ranks come from ``ordered.running`` (no one-task window); the donor
    lookup is an equi-join on (feature, repeat, rank).
    """
    base = running(df, [], [id_col]).withColumnRenamed("row_number", "_rank_id")
    exploded = base.select(
        F.col(id_col), F.col("_rank_id"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("perm_feature"), F.lit(r).alias("perm_repeat"))
                            for f in features for r in range(repeats)])).alias("pr"),
    ).select(id_col, "_rank_id", "pr.perm_feature", "pr.perm_repeat")
    exploded = exploded.withColumn("_h", hash_uniform(F.col(id_col), F.col("perm_feature"), F.col("perm_repeat"), seed=seed))
    ranked = running(exploded, ["perm_feature", "perm_repeat"], ["_h", id_col]).withColumnRenamed("row_number", "_rank_h")
    # Row with hash rank k donates its value to the row with id rank k.
    donors = ranked.select("perm_feature", "perm_repeat", F.col("_rank_h").alias("_rank_id"), F.col(id_col).alias("_donor"))
    pairs = exploded.select(id_col, "_rank_id", "perm_feature", "perm_repeat").join(donors, ["perm_feature", "perm_repeat", "_rank_id"])
    own = base.drop("_rank_id")
    donor_vals = own.select(F.col(id_col).alias("_donor"), *[F.col(f).alias(f"_d_{f}") for f in features])
    joined = pairs.join(own, id_col).join(donor_vals, "_donor")
    cols = [
        F.when(F.col("perm_feature") == F.lit(c), F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) if c in features else F.col(c)
        for c in df.columns
    ]
    return joined.select(*cols, "perm_feature", "perm_repeat")
