"""The operators on the given tables, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumenfold.llm import (
    bpe_chunks,
    centroids,
    decontaminate,
    language_id,
    license_scan,
    packing,
    quote_links,
    secret_scan,
    simhash,
    structure_repair,
    suffix_dedup,
    topk_search,
    toxicity,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, folder, "documents"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op3_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(table(spark, folder, "embeddings"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op7_quote_links(spark: SparkSession, folder: str) -> DataFrame:
    return quote_links.reply_ordered(table(spark, folder, "conversations"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.document_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return structure_repair.repaired_digests(structure_repair.damaged(table(spark, folder, "conversations")), alive="alive")


def op12_bpe_chunks(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe_chunks.encode(table(spark, folder, "documents"), vocabulary, bpe_chunks.digests())


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


ALL = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_secret_scan,
        op3_topk_search,
        op4_license_scan,
        op5_language_id,
        op6_best_fit_packing,
        op7_quote_links,
        op8_toxicity,
        op9_simhash_dedup,
        op10_decontaminate,
        op11_structure_repair,
        op12_bpe_chunks,
        op13_centroid_clusters,
    )
}
