"""Random permutations of ranks without sorting: a Feistel network with cycle walking.

``donor`` is a bijection of 0 .. n-1 for every key.  Four rounds of a keyed hash permute the
smallest domain of 4^k numbers that holds n; a number that lands outside 0 .. n-1 is sent through
again until it is inside (fewer than four times on average), which keeps the map a bijection.
A row finds the row that lends it a value from its own rank alone.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcast.operators.ordered import running
from callcast.session import materialize, ship_package

_ROUNDS = 4


def _hash(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        for mul in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> np.uint64(33))) * np.uint64(mul)
        return x ^ (x >> np.uint64(33))


def feistel(ranks: np.ndarray, n: int, keys: np.ndarray) -> np.ndarray:
    """The image of every rank (0 .. n-1) under the permutation of its key."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    x, keys = ranks.astype(np.uint64), keys.astype(np.int64).view(np.uint64)
    todo = np.ones(len(x), dtype=bool)
    while todo.any():
        v, k = x[todo], keys[todo]
        left, right = v >> half, v & mask
        for r in range(_ROUNDS):
            with np.errstate(over="ignore"):
                mixed = _hash(right * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r + 1) * np.uint64(0xBF58476D1CE4E5B9))
            left, right = right, left ^ (mixed & mask)
        x[todo] = (left << half) | right
        todo[todo] = x[todo] >= n
    return x.astype(np.int64)


def donor(rank: Column, n: int, key: Column) -> Column:
    """Column form of ``feistel``."""

    @F.pandas_udf("long")
    def walk(r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series(feistel(r.to_numpy(), n, k.to_numpy()))

    return walk(rank, key)


def ranked(df: DataFrame, id_col: str = "contact_id") -> tuple[DataFrame, int]:
    """``df`` with ``_rank`` (0 .. n-1, by id), written; and n."""
    out = materialize(running(df, [], [id_col]).withColumn("_rank", F.col("row_number") - 1).drop("row_number"), "ranked")
    return out, out.count()


def permuted(rows: DataFrame, n: int, feature: str, repeats: int = 10, seed: int = 42) -> DataFrame:
    """``rows`` (with ``_rank``) once per repeat, its ``feature`` taken from the donor; adds ``perm_repeat``.

    Only (rank, value) pairs of the one column are shuffled: n * repeats of them.  The other columns
    are never copied across the cluster; the repeats of a row are laid out next to it.
    """
    ship_package(rows.sparkSession)
    kind = rows.schema[feature].dataType
    asks = rows.select("_rank", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("perm_repeat"))
    asks = asks.withColumn("_donor", donor(F.col("_rank"), n, F.xxhash64(F.lit(feature), "perm_repeat", F.lit(seed))))
    values = rows.select(F.col("_rank").alias("_donor"), F.col(feature).alias("value"))
    lent = asks.join(values, "_donor").groupBy("_rank").agg(F.sort_array(F.collect_list(F.struct("perm_repeat", "value"))).alias("_lent"))
    kept: Sequence[str] = [c for c in rows.columns if c not in (feature, "_rank")]
    return rows.select("_rank", *kept).join(lent, "_rank").select(*kept, F.explode("_lent").alias("x")).select(*kept, F.col("x.value").cast(kind).alias(feature), F.col("x.perm_repeat").alias("perm_repeat"))
