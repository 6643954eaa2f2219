"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import ann, bpe, chat, langid, line_dedup, media, packing, sharding, simhash, suffix_dedup
from tidelog.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> tuple[str, str]:
    """A public vocabulary file's place and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(table(spark, sf_dir, "documents"), *tokenizer("byte_bpe_50k.tiktoken"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"), *tokenizer("byte_bpe_50k.json"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.query(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(table(spark, sf_dir, "conversations"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(table(spark, sf_dir, "documents"))


def op9_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.query(table(spark, sf_dir, "documents"))


def op10_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.query(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_media": op2_media,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash": op6_simhash,
    "op7_langid": op7_langid,
    "op8_packing": op8_packing,
    "op9_hash_tree": op9_hash_tree,
    "op10_adaptive_scan": op10_adaptive_scan,
}

ORACLES: dict[str, str] = {
    "op4_chat_format": chat.ORACLE,
}
