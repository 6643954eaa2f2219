"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id: such rows sort after every other row.
NULL_ID = 2**63 - 1
#: Rows of one Arrow batch sent to a Python worker; with long texts, few rows make a batch large.
BATCH_ROWS = 128
#: Rows of numbers, or characters of text, that aren't worth several tasks.
SMALL_ROWS, SMALL_CHARS = 100_000, 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import this package from where the driver has it; elsewhere it must be installed or sent along."""
    environment = spark.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: whole texts travel, so few rows travel at once."""
    workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def thrifty(run: Callable) -> Callable:
    """A function of Arrow batches that gives memory back to the system when its task ends: idle workers keep little."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return runs


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: the cluster's shared folder is taken from spark.checkpoint.dir; one is made only where none is set, by a session on one machine."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelog-checkpoints-"))


def few_partitions(df: DataFrame, rows: int, chars: int = 0) -> DataFrame:
    """df, of so many rows and characters, in as few partitions as they need; a single one needs no exchange in what follows."""
    return df.coalesce(max(1, -(-rows // SMALL_ROWS), -(-chars // SMALL_CHARS)))


def compact(df: DataFrame, at_most: int | None = None) -> DataFrame:
    """df of narrow rows, checkpointed, in as few partitions as its rows need; they are known to be at_most so many, if anything is known."""
    df = (df if at_most is None else few_partitions(df, at_most)).checkpoint()
    return few_partitions(df, df.count())


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again."""
    spark = df.sparkSession
    shared_checkpoints(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


#: A value that more than one in so many rows hold is a hot one; there are fewer of them than this, whatever the table.
HOT = 1000


def join_groups(rows: DataFrame, groups: DataFrame, by: str, total: int) -> DataFrame:
    """rows joined with groups, which have one row for each value of a column, and the number n of rows that hold it.

    Hot values (fewer than HOT) are broadcast, so that their rows stay where they are; the others meet in an exchange,
    where none brings more than one in HOT of all rows. rows and groups are read twice.
    """
    hot = groups.where(F.col("n") > total / HOT)
    here = rows.join(F.broadcast(hot), by)
    rest = rows.join(F.broadcast(hot.select(by)), by, "left_anti").join(groups.where(F.col("n") <= total / HOT), by)
    return here.unionByName(rest)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def order_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def text_bytes(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return batch.column(name).to_pylist()


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches from row tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
