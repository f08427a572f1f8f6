"""From raw documents to token ids: five stages, each over all rows its predecessor kept.

``run(spark, sf_dir)`` writes every stage's result to the shared folder and reads it back as the next one's input. ``text`` may be
null at any stage; an empty table passes through. A stage's models and statistics come from its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm import decontaminate, ngram_join, pii_crf, quality, sentencepiece_codec
from weekloom.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; the rules run in the order of rejections per cost found on a sample."""
    return quality.QualityCascade().fit(docs).keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and of texts linked by their 5-grams."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii_crf.mask_documents(docs, pii_crf.fitted(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents with parity and round trip."""
    return sentencepiece_codec.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]
# segments of a trained field and token ids are beyond SQL; the pipeline is tested against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
