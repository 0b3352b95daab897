"""Queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, embedding_dedup, lm, mixing, quality, repeats, sharding, simhash, topk, url_filter
from .common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.cluster(table(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, cached=320_000)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_embedding_dedup,
        op3_sharding,
        op4_mixing,
        op5_quality,
        op6_bpe,
        op7_repeats,
        op8_simhash,
        op9_topk,
        op10_lm,
    )
}
ORACLES = {"op1_url_filter": url_filter.oracle(), "op2_embedding_dedup": embedding_dedup.ORACLE, "op7_repeats": repeats.ORACLE, "op9_topk": topk.ORACLE}
