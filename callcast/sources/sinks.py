"""Sinks: report CSV, MapReduce-style TSV, JSON summary, model artifacts.

All writes run on the executors (``DataFrame.write``); nothing is collected
to the driver.  ``coalesce(1)`` is used only for small reports where a single
readable file is the point; large outputs keep their partitioning.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_report(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = True) -> None:
    """Header CSV; one file for (small) reports.  ``mode`` is honoured."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def save_tsv(df: DataFrame, path: str, key: str, avg_col: str, count_col: str) -> None:
    """``key<TAB>avg<TAB>count`` lines, average as fixed two-decimal text, key order."""
    (
        df.select(
            F.col(key).cast("string"),
            F.format_string("%.2f", F.col(avg_col)).alias(avg_col),
            F.col(count_col).cast("string"),
        )
        .orderBy(key)
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", False)
        .csv(path)
    )


def save_summary(spark: SparkSession, values: Mapping[str, object], path: str) -> None:
    """Headline values as a one-row JSON document (written by an executor)."""
    row = {k: (v if isinstance(v, (int, float, str, bool)) or v is None else str(v)) for k, v in values.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Temp view for SQL users (the reference's ``createOrReplaceTempView``)."""
    df.createOrReplaceTempView(name)
    return df


def create_csv_table(spark: SparkSession, name: str, path: str, database: str | None = None) -> DataFrame:
    """External-table equivalent: a CSV table with the fixed schema over ``path``."""
    from callcast.schema import BANK_SCHEMA

    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in BANK_SCHEMA.fields)
    full = f"{database}.{name}" if database else name
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(
        f"CREATE TABLE {full} ({cols}) USING csv OPTIONS (header 'true', sep ',', quote '\"', path '{path}')"
    )
    return spark.table(full)
