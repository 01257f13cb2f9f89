"""A corpus pipeline: from raw documents to packed sequences of token ids.

Each stage calls one operator of ``threadsift.llm`` and works on all documents that the
stages before it kept. ``run`` writes every stage's result to the shared folder as
Parquet and reads it again, so a lost executor costs a read and later stages read only
what they need. All but the last stage return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadsift.llm import classifier, neardup, packing, quality_rules, secrets, tokens
from threadsift.llm.common import table
from threadsift.session import written

#: What stands for a secret in the texts that go on.
MARK = "[SECRET]"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    return classifier.kept(docs, table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled thresholds."""
    return quality_rules.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the least id."""
    return neardup.kept(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secrets.redact(docs, MARK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.pack(docs, tokens.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: SQL can't express the trained classifier, the signatures or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
