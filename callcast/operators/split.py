"""Deterministic splits, folds and samples.

``randomSplit`` depends on partitioning (and on the order rows reach each
task), so a rerun on a different cluster gives a different split.  Here every
row's fate is a pure function of (contact_id, seed) through ``md5``, so the
split is the same on any partitioning, after any executor loss, and in DuckDB.

Exact per-class counts need each row's rank inside its label.  With only two
labels a ``Window.partitionBy(label)`` would put half the table in one task;
here a label is ranked in many buckets of the hash (see ``_class_ranks``).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def md5_key(id_col: str = "contact_id", seed: int = 42) -> Column:
    """md5 hex of '<id>-<seed>' (identical text in Spark and DuckDB)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def hash_split(df: DataFrame, fraction: float, seed: int = 42, id_col: str = "contact_id", complement: bool = False) -> DataFrame:
    """Rows whose md5 prefix falls under ``fraction`` of the 32-bit range.

    Approximate fraction, no shuffle: a narrow filter (stands in for
    ``randomSplit``).  ``fraction=0.6`` gives the prefix bound '99999999'.
    ``complement=True`` returns the other rows (the held-out part), also
    without a join.
    """
    bound = format(min(int(fraction * 16**8), 16**8 - 1), "08x")
    inside = F.substring(md5_key(id_col, seed), 1, 8) < F.lit(bound)
    return df.where(~inside if complement else inside)


def _class_ranks(df: DataFrame, label_col: str, seed: int, id_col: str) -> DataFrame:
    """Adds ``_rank`` (1-based, by md5 inside the label) and ``_n`` (label size).

    md5 is uniform, so its first four hex digits deal a label into 65,536 even
    buckets in md5 order: the rank is the number of rows in the buckets before
    plus the row number inside the bucket.
    """
    bucket = F.substring(md5_key(id_col, seed), 1, 4)
    counts = df.groupBy(F.col(label_col).alias("_l"), bucket.alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("_l").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_l", "_k", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"), F.sum("_c").over(Window.partitionBy("_l")).alias("_n"))
    inside = Window.partitionBy(label_col, "_b").orderBy("_h", id_col)
    local = df.withColumns({"_h": md5_key(id_col, seed), "_b": bucket}).withColumn("_i", F.row_number().over(inside))
    ranked = local.join(starts, F.col(label_col).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_k")))
    return ranked.withColumn("_rank", F.col("_start") + F.col("_i")).drop("_l", "_k", "_c", "_start", "_h", "_b", "_i")


def stratified_split(
    df: DataFrame,
    fractions: Sequence[float] = (0.6, 0.2, 0.2),
    names: Sequence[str] = ("train", "validation", "test"),
    label_col: str = "y",
    seed: int = 42,
    id_col: str = "contact_id",
) -> DataFrame:
    """Adds ``split``: exact per-class shares, rows ordered by md5 inside each class.

    Part i of class c holds the rows whose rank r satisfies
    ``round(n_c * F_{i-1}) < r <= round(n_c * F_i)`` with cumulative shares F
    (round half up), so the parts are disjoint and cover every row.
    """
    if abs(sum(fractions) - 1.0) > 1e-9 or len(fractions) != len(names):
        raise ValueError("fractions must sum to 1, one per name")
    ranked = _class_ranks(df, label_col, seed, id_col)
    cum, expr = 0.0, None
    for frac, name in zip(fractions[:-1], names[:-1]):
        cum += frac
        cond = F.col("_rank") <= F.floor(F.col("_n") * F.lit(cum) + F.lit(0.5))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = expr.otherwise(F.lit(names[-1])) if expr is not None else F.lit(names[-1])
    return ranked.withColumn("split", expr).drop("_rank", "_n")


def kfold_assign(
    df: DataFrame,
    k: int = 5,
    seeds: Sequence[int] = (42,),
    label_col: str = "y",
    id_col: str = "contact_id",
    prefix: str = "fold",
) -> DataFrame:
    """Stratified folds: ``fold_<seed>`` = (rank inside the label by md5) mod k.

    One column per seed (a repeat).  Every fold holds floor or ceil of n_c/k
    rows of each class.  The columns feed ``CrossValidator(foldCol=...)``.
    """
    out = df
    for s in seeds:
        ranked = _class_ranks(out, label_col, s, id_col)
        out = ranked.withColumn(f"{prefix}_{s}", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")
    return out


def fixed_sample(df: DataFrame, n: int = 1200, seed: int = 42, id_col: str = "contact_id") -> DataFrame:
    """min(n, rows) rows, chosen by md5 order (a bounded top-n, not a collect)."""
    return df.withColumn("_h", md5_key(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")


def split_summary(df: DataFrame, split_col: str = "split", label_col: str = "y") -> DataFrame:
    return (
        df.groupBy(split_col)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(F.avg(F.when(F.col(label_col) == "yes", 1).otherwise(0)), 4).alias("positive_rate"),
        )
        .orderBy(split_col)
    )


def split_integrity(parts: Mapping[str, DataFrame], source: DataFrame, id_col: str = "contact_id") -> DataFrame:
    """(check, passed, details): no id in two parts; parts cover the source exactly.

    One grouped count over the ids of the parts and of the source together, so that no side is
    ever joined, let alone sent whole to the driver as a broadcast (an id column of millions of
    rows looks small in Parquet).  A null id equals no other: it is missing, and foreign.
    """
    none = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    ids = source.select(F.col(id_col).alias("_id"), none.alias("_p"), one.alias("_s"))
    for part in parts.values():
        ids = ids.unionByName(part.select(F.col(id_col).alias("_id"), one.alias("_p"), none.alias("_s")))
    per_id = ids.groupBy("_id").agg(F.sum("_p").alias("_p"), F.sum("_s").alias("_s"))
    missing = (F.col("_p") == 0) | F.col("_id").isNull()
    foreign = (F.col("_p") > 0) & ((F.col("_s") == 0) | F.col("_id").isNull())
    checks = {"no_overlap": F.count_if(F.col("_p") > 1), "covers_source": F.sum(F.when(missing, F.col("_s"))), "no_foreign_rows": F.count_if(foreign)}
    counts = per_id.agg(*[F.coalesce(v, none).alias(k) for k, v in checks.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("check"), (F.col(k) == 0).alias("passed"), F.col(k).alias("offending_ids")) for k in checks])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def parts_of(df: DataFrame, split_col: str = "split") -> dict[str, DataFrame]:
    names = [r[0] for r in df.select(split_col).distinct().collect()]  # a handful of labels
    return {n: df.where(F.col(split_col) == n).drop(split_col) for n in sorted(names)}
