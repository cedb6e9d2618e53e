"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinio.llm import decontaminate, dedup, packing, pii, quality
from opinio.llm.common import fold, table
from opinio.llm.queries import VOCABULARY
from opinio.session import new_path, remove, scope


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    return quality.keep_good(docs, quality.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and secrets in the texts."""
    return pii.mask_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' ids into sequences; one row per piece."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii_masking),
    ("packing", sequence_packing),
]

# Learned scores, fingerprints and alignments are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written to the shared folder and read again.

    What a stage has written for itself goes once its result is written, and a result once the
    next stage's is.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scope(spark, f"{name}-work"):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
