"""Raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents its predecessor kept and the folder of the
tables. Its result is written as Parquet and read again before the next one starts. No
stage is expressible in SQL as a whole, so the stages are tested against plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import mixing, packing, quality, secrets, simhash
from tierline.llm.common import Store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the risk-controlled rules of their language."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), Store(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose fingerprints are linked, as operator 3 links them."""
    return simhash.keep_first(docs, Store(spark))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked."""
    return secrets.mask_secrets(docs, Store(spark))


def domain_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the labelled domains ask for."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), Store(spark))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_masking", secret_masking),
    ("domain_mixing", domain_mixing),
    ("sequence_packing", sequence_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return docs
