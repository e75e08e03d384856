"""Training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages but
the last keep the columns of ``documents``. Methods, parameters and the results
for nulls, ties and repeated rows are described in the operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from importlens.llm import decontaminate, language_id, line_dedup, sentencepiece_codec, simhash_dedup
from importlens.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter) or with a doubtful one go."""
    return language_id.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines of all documents one stays; the others leave their texts."""
    return line_dedup.deduplicated(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash_dedup.keep_one(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, decoded again as a check."""
    return sentencepiece_codec.encoded(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("sentencepiece", encode_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers, fingerprints and piece segmentation are not expressible in SQL; tests use a brute-force version.
ORACLE_SQL = None
