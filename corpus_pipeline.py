"""A training-corpus pipeline over ``documents``: five filtering stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callcast.llm import decontaminate, jaccard_join, langid, mixing, suffix_dedup
from callcast.llm.queries import MIX_KEEP, MIX_POWERS, MIX_ROUNDS, MIX_SEED, with_topic
from callcast.session import materialize
from callcast.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go (no letters, or far from every centroid)."""
    return langid.identify(docs).where("NOT rejected").select(*docs.columns)


PASSAGE_BYTES, PASSAGE_GRAM = suffix_dedup.PASSAGE_BYTES, suffix_dedup.PASSAGE_GRAM


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate documents the one with the smallest doc_id stays.

    Groups are closed over chains of links, so a document may go whose own likeness
    to the one that stays is below the limit.
    """
    return jaccard_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose every passage of PASSAGE_BYTES or more that occurs again; documents of which nothing is left go."""
    cut = suffix_dedup.deduplicate(docs, length=PASSAGE_BYTES, gram=PASSAGE_GRAM, as_text=True)
    left = cut.where((F.col("n_removed") == 0) | (F.length("kept") > 0))
    changed = F.col("n_removed") > 0
    return left.withColumns(
        {"text": F.when(changed, F.col("kept")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars"))}
    ).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose source, language and topic shares follow the target weights; adds topic, tokens and prob."""
    drawn = mixing.sample(with_topic(docs), list(MIX_POWERS), MIX_POWERS, keep_share=MIX_KEEP, rounds=MIX_ROUNDS, seed=MIX_SEED)
    return drawn.where("kept").drop("kept")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("source_mixture", mixture),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
