"""The corpus pipeline: language ID, exact and near dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import contamination, exact, langid, mixing, probminhash
from tidewatch.llm.common import small_batches, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the learned languages; labels of two thirds of the documents teach and calibrate."""
    small_batches(spark)
    labelled = docs.filter(~langid.held_out(F.col("doc_id")))
    model = langid.fit(labelled)
    return langid.accepted(langid.predict(docs.select(*COLUMNS), model), langid.calibrated(labelled, model)).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the smallest id."""
    return exact.deduplicated(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    small_batches(spark)
    return probminhash.one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words of benchmark passages go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that it takes, with their text, their number of copies and their source's target."""
    return mixing.mixed_texts(docs)


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("decontamination", decontamination), ("mixing", mixing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
