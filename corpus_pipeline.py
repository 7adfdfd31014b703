"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared
folder and read again as the next stage's docs. All but the last return the columns of `documents`.

1. quality_classifier: documents that the classifier rejects go; it learns from the labels of documents
   that are still there and not held out.
2. simhash_near_dedup: of each group of near duplicates the document with the least doc_id stays.
3. secret_scans: every reported span is masked in the text, and n_chars follows.
4. mixing: documents come as often, and as far, as the mix takes them, sorted by training position.
5. best_fit_packing: token pieces with sequence_id and offset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lettermill.llm import catalog, mixing, packing, quality, secrets, simhash
from lettermill.session import materialize, ready, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(ready(spark), sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, catalog.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier, the fingerprints and the tokenizer are not SQL: tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
