"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, line_dedup, near_duplicates, nearest, quality, sharding, substring_dedup, token_counts, url_filters

#: The public rule list of the url query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), 24, keep_at=sharding.map_folder(spark, uuid.uuid4().hex))
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), byte_bpe.read_ranks(tokenizer_path(ranks)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    with open(tokenizer_path(vocabulary), encoding="utf-8") as file:
        return token_counts.token_counts(table(spark, sf_dir, "documents"), file.read())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": op1_url_filters,
        "op2_decontamination": op2_decontamination,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_line_dedup": op5_line_dedup,
        "op6_sharding": op6_sharding,
        "op7_nearest": op7_nearest,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_quality": op9_quality,
        "op10_token_counts": op10_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLES

    return ORACLES
