"""Registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from tierline.llm import (
    alignment,
    edit_counts,
    html_text,
    mixing,
    near_fingerprints,
    neighbours,
    packing,
    quality,
    repeats,
    secrets,
    simhash,
    spelling,
    token_files,
)
from tierline.llm.common import Store, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeats.digest(repeats.remove_repeats(docs, Store(spark)))


def op2_sharded_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark)
    embeddings = table(spark, sf_dir, "embeddings")
    vectors = store.keep(neighbours.usable_vectors(embeddings, "vec_id", "embedding"), "vectors")
    index = neighbours.build_index(vectors, store)
    return neighbours.search(index, vectors.where(F.col("id") % 100 == 0))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Store(spark))
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return mixing.mix_rates(docs, labels, Store(spark))


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Store(spark).path("tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"), Store(spark))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.judge(docs, labels, Store(spark))


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    trees = Store(spark).keep(edit_counts.build_trees(docs, vocabulary), "trees")
    return edit_counts.count_after(trees, edit_counts.sample_edits(), vocabulary)


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_simhash_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints.digest(
        near_fingerprints.compare_edits(table(spark, sf_dir, "documents"), Store(spark))
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), Store(spark))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(
        table(spark, sf_dir, "documents"),
        Store(spark),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def queries() -> dict[str, Query]:
    found = [
        op1_repeated_strings,
        op2_sharded_graphs,
        op3_simhash_golay,
        op4_soft_mixing,
        op5_text_density,
        op6_token_files,
        op7_secret_scan,
        op8_quality_rules,
        op9_edit_counts,
        op10_pattern_packing,
        op11_simhash_tables,
        op12_spelling_variants,
        op13_tokenizer_alignment,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {}
