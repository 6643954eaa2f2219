"""The corpus pipeline: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import langid, line_dedup, packing, simhash, suffix_dedup
from tidelog.llm.common import stored, table
from tidelog.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model accepts."""
    return langid.keep_accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one, but for two edits."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_firsts(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes or more that an earlier one has."""
    return suffix_dedup.dedup_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of bounded length."""
    return packing.pack(docs, *tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_copies", near_copies),
    ("passages", passages),
    ("packing", sequences),
]

#: Hashing, models and tokenisation are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are stored in the shared folder before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
