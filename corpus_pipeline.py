"""The corpus pipeline: documents that are good and clean, one of each group of near copies, without personal data,
packed into training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents. The SQL is None: the verdicts come from expectation-maximisation and trained models. Null and empty texts
fail the quality rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import jaccard_join, packing, pii_crf, quality_rules, toxicity_ftrl
from snapmart.llm.common import CUT, finished_shuffles_removed, fold, table, written

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality_rules.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted to be toxic, by a model of the labelled ones outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 4) != 2)
    model = toxicity_ftrl.fit(docs, labels)
    score = "toxicity" + "_" * max(map(len, docs.columns))  # longer than any column's name
    return toxicity_ftrl.with_score(docs, model, score=score).where(F.col(score) < CUT).drop(score)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares at least 80 % of its shingles of five words."""
    with finished_shuffles_removed(spark):
        return jaccard_join.one_of_each(docs, size=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; n_chars follows the text."""
    masked = pii_crf.mask(docs, pii_crf.fit(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity_ftrl", toxicity_stage),
    ("jaccard_join", near_copies_stage),
    ("pii_crf", personal_data_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
