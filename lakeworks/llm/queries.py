"""Queries of this subpackage, with DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (byte_bpe, chat_format, exact_dedup, hard_negatives, packing, periodic_runs, secret_scan, sharding, shingle_join,
               suffix_dedup, token_counts, toxicity, vector_search)
from .common import table


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_documents(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shingle_join": shingle_join.query,
    "op2_sharding": sharding.query,
    "op3_byte_bpe": op3,
    "op4_token_counts": op4,
    "op5_chat_format": chat_format.query,
    "op6_toxicity": toxicity.query,
    "op7_suffix_dedup": suffix_dedup.query,
    "op8_vector_search": vector_search.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_packing": op10,
    "op11_secret_scan": secret_scan.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_hard_negatives": hard_negatives.query,
}

ORACLE: dict[str, str] = {
    "op2_sharding": sharding.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
}
