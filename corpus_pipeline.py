"""A corpus pipeline in five stages: quality, near duplicates, benchmark leaks, secrets, mixing.

Each stage works on all rows that the one before it kept and returns the columns of `documents`, but for
the last, which returns what the mix takes of each document. Results of stages are written as Parquet in
the shared folder (see `carelake.llm.common.staging_folder`) and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import common, decontam, mixing, ngram_join, quality, secret_scan


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that boosted trees, learned from the learnable labels of the documents, don't reject."""
    labels = quality.learnable(common.table(spark, sf_dir, "labels"))
    return quality.kept(docs, quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redacted(docs, secret_scan.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mixed(docs)


STAGES = [
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mix),
]
#: None: the classifier, the retrieval and the draws of the mix have no counterpart in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir))
    return docs
