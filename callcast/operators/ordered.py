"""Ordered running computations without a one-task window.

``Window.partitionBy(key).orderBy(...)`` sends every row of one key to one
task, and ``Window.orderBy(...)`` without a key sends the whole table there.
With a key that holds a third of the rows, that task holds a third of the data.

``running`` gives the same results (row number, running sums and the previous
row's values inside each key, in a total order) in three steps:

1. range-partition on (key, order) so a hot key is split over many
   partitions, and keep the partition number with each row (written as Parquet,
   because the range partitioner samples its bounds anew for every plan);
2. a window inside (partition, key) gives the local row number, running sums
   and previous values: every group is bounded by the size of a partition, and
   all columns stay in the JVM with their types;
3. a summary with ONE ROW PER PARTITION (so its size is bounded by the
   partition count, not by the data) gives each partition the carry from the
   partitions before it.  It is broadcast and added to the rows whose key
   continues from an earlier partition.

The order must be total (end it with a unique column) for a deterministic
result; then a recomputed partition after an executor loss gives the same rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callcast.session import materialize

_PID = "_rp_pid"
_RN = "_rp_rn"


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    lags: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Row number, running sums and previous values inside ``keys``, by ``order``.

    Adds ``row_number`` (1-based), ``cum_<s>`` (inclusive running sum, DOUBLE)
    for each ``s`` in ``sums`` and ``prev_<c>`` (NULL on a key's first row) for
    each ``c`` in ``lags``.  ``keys`` may be empty for one global order.
    Everything is ascending (NULLs first); negate a numeric column for a
    descending order.
    """
    keys, order, sums, lags = list(keys), list(order), list(sums), list(lags)
    columns = df.columns
    sort_spec = [F.col(c).asc() for c in keys + order]
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *sort_spec)
    else:
        # No fixed count: spark.sql.shuffle.partitions ranges, which AQE may
        # coalesce into contiguous (still ordered) groups when they are small.
        ranged = df.repartitionByRange(*sort_spec)
    cut = materialize(ranged.withColumn(_PID, F.spark_partition_id()), "ordered")
    near = Window.partitionBy(_PID, *keys).orderBy(*sort_spec)
    upto = near.rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(
        "*",
        F.row_number().over(near).cast("long").alias(_RN),
        *[F.sum(F.coalesce(F.col(s).cast("double"), F.lit(0.0))).over(upto).alias(f"cum_{s}") for s in sums],
        *[F.lag(c).over(near).alias(f"prev_{c}") for c in lags],
    )

    # Per-partition summary from the same rows: first key, last key with its
    # row's values, and the size / sums of the last key's run.  min/max over
    # (key, order) structs: exact because the order is total.
    key_struct = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    pos = F.struct(key_struct.alias("k"), F.struct(*[F.col(c) for c in order]).alias("o"))
    ends = local.groupBy(_PID).agg(
        F.min(pos).getField("k").alias("first_key"),
        F.max(F.struct(pos.alias("p"), F.col(_RN).alias("cnt"), *[F.col(f"cum_{s}").alias(f"sum_{s}") for s in sums],
                       *[F.col(c).alias(f"val_{c}") for c in lags])).alias("_last"),
    )
    summary = ends.select(
        _PID,
        "first_key",
        F.struct(F.col("_last.p.k").alias("k"), *[F.col(f"_last.val_{c}").alias(f"val_{c}") for c in lags]).alias(
            "last"
        ),
        F.col("_last.cnt").alias("cnt"),
        *[F.col(f"_last.sum_{s}").alias(f"sum_{s}") for s in sums],
    )
    # One row per partition: a window without a key is fine on it.
    w_all = Window.orderBy(_PID)
    w_key = Window.partitionBy(F.col("last.k")).orderBy(_PID).rowsBetween(Window.unboundedPreceding, 0)
    summary = summary.select(
        _PID,
        "first_key",
        "last",
        F.sum("cnt").over(w_key).alias("run_cnt"),
        *[F.sum(f"sum_{s}").over(w_key).alias(f"run_{s}") for s in sums],
    )
    prev = lambda c: F.lag(c).over(w_all)
    carries = summary.select(
        _PID,
        (prev(F.col("last.k")).eqNullSafe(F.col("first_key"))).alias("continues"),
        prev(F.col("run_cnt")).alias("carry_cnt"),
        *[prev(F.col(f"run_{s}")).alias(f"carry_{s}") for s in sums],
        *[prev(F.col(f"last.val_{c}")).alias(f"carry_val_{c}") for c in lags],
        F.col("first_key"),
    ).where(F.col("continues"))

    # One row per partition at most: bounded by the partition count, so the
    # broadcast is safe whatever the data size.
    joined = local.join(F.broadcast(carries), on=_PID, how="left")
    head = F.coalesce(F.col("continues"), F.lit(False)) & key_struct.eqNullSafe(F.col("first_key"))
    outs = [F.col(c) for c in columns]
    outs.append((F.col(_RN) + F.when(head, F.col("carry_cnt")).otherwise(F.lit(0))).alias("row_number"))
    for s in sums:
        outs.append((F.col(f"cum_{s}") + F.when(head, F.col(f"carry_{s}")).otherwise(F.lit(0.0))).alias(f"cum_{s}"))
    for c in lags:
        first_local = F.col(_RN) == 1
        outs.append(
            F.when(head & first_local, F.col(f"carry_val_{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}")
        )
    return joined.select(*outs)


#: Rows up to which ``running_counts`` uses a plain window (some tens of MB in one task).
FEW_ROWS = 1_000_000


def running_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str], few: int = FEW_ROWS) -> DataFrame:
    """``cum_<s>`` as in ``running``, for a grouped table (one row per distinct value).

    The table is written first and its rows are counted: up to ``few`` of them a window over each
    key is one small task and needs neither sampled ranges nor carries; beyond, ``running`` does it.
    The result is the same.
    """
    grouped = materialize(df, "grouped")
    if grouped.count() > few:
        return running(grouped, keys, order, sums).drop("row_number")
    upto = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    return grouped.select("*", *[F.sum(F.coalesce(F.col(s).cast("double"), F.lit(0.0))).over(upto).alias(f"cum_{s}") for s in sums])
