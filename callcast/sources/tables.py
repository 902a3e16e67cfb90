"""Driver tables (Parquet) and explicit-schema CSV contact files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcast.schema import BANK_SCHEMA, CONTACT_COLUMNS, STREAMING_SCHEMA

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet gives column pruning and filter pushdown."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_contacts(spark: SparkSession, path: str, with_id: bool = True) -> DataFrame:
    """Header CSV with the fixed 17-column schema (no inference).

    ``enforceSchema=False`` makes Spark check the header names against the
    schema, so a reordered or renamed file fails instead of loading shifted
    columns.  ``with_id`` adds ``contact_id``, 1-based in the order of file name
    and position in the file, whatever the size and packing of the file splits.
    """
    df = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .schema(BANK_SCHEMA)
        .csv(path)
    )
    if with_id:
        from callcast.operators.ordered import running

        # A split's rows are read in order, and its start orders the splits of a file.
        place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id()}
        df = df.select("*", *[c.alias(n) for n, c in place.items()])
        df = running(df, [], list(place)).select(F.col("row_number").alias("contact_id"), *CONTACT_COLUMNS)
    return df


def scan_stream_csv(spark: SparkSession, folder: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Streaming CSV source watching ``folder`` (schema given, header per file)."""
    reader = spark.readStream.option("header", True).schema(STREAMING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)
