"""ordered.running against a plain window, with a hot key split over many partitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from callcast.operators.ordered import running


def _frame(spark, n=5000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 1 if rnd.random() < 0.4 else rnd.randint(2, 60)  # key 1 holds ~40% of the rows
        rows.append((i, key, rnd.randint(0, 50), float(rnd.randint(-5, 5)), rnd.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "id long, k long, t int, v double, s string")


def _reference(df):
    w = Window.partitionBy("k").orderBy("t", "id")
    return df.select(
        "id",
        F.row_number().over(w).alias("rn_ref"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_ref"),
        F.lag("t").over(w).alias("lag_t_ref"),
        F.lag("s").over(w).alias("lag_s_ref"),
    )


def test_running_matches_window_with_hot_key(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # many Arrow batches per partition
    try:
        df = _frame(spark)
        got = running(df, ["k"], ["t", "id"], sums=["v"], lags=["t", "s"], num_partitions=13)
        j = got.join(_reference(df), "id")
        bad = j.where(
            (F.col("row_number") != F.col("rn_ref"))
            | (F.abs(F.col("cum_v") - F.col("cum_ref")) > 1e-9)
            | ~F.col("prev_t").eqNullSafe(F.col("lag_t_ref"))
            | ~F.col("prev_s").eqNullSafe(F.col("lag_s_ref"))
        )
        assert got.count() == df.count()
        assert bad.count() == 0
        # the hot key really spans several range partitions
        parts = df.repartitionByRange(13, "k", "t", "id").where(F.col("k") == 1).select(F.spark_partition_id()).distinct().count()
        assert parts > 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_running_global_order(spark):
    df = _frame(spark, 2000, seed=3)
    got = running(df, [], ["t", "id"], sums=["v"], num_partitions=7)
    w = Window.orderBy("t", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn_ref"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    j = got.join(ref, "id")
    assert j.where((F.col("row_number") != F.col("rn_ref")) | (F.abs(F.col("cum_v") - F.col("c")) > 1e-9)).count() == 0


def test_grouped_tables_give_the_same_either_way(spark):
    from callcast.operators.ordered import running_counts

    df = spark.range(900).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1000).alias("v"), (F.col("id") % 5).alias("n"))
    same = [sorted(map(tuple, running_counts(df, ["k"], ["v"], ["n"], few).select("k", "v", "n", "cum_n").collect())) for few in (1000, 10)]
    assert same[0] == same[1] and len(same[0]) == 900
