"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, mixing.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` applies them in order to ``documents``, writing
each result as Parquet in the shared checkpoint folder and reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import decontaminate, langid, mixing, secrets, simhash_dedup
from tillstream.llm.common import load, staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go; it learns from the training rows of docs."""
    return langid.accepted(docs, langid.learn(langid.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (least doc_id)."""
    return simhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, load(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported spans are replaced by a mark; every document stays."""
    return secrets.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words to read of each."""
    return mixing.mixed(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("mixing sources", mixture),
]

#: SQL cannot express the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
