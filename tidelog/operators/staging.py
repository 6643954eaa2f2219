"""Staged mutations: an append-only log and a log of what was applied of it.

Staged rows are (tbl, key, nanos, logical, data, before); the applied log holds (tbl, key, nanos, logical).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import hlc
from tidelog.operators.dedup import last_by_time_key
from tidelog.operators.poison import shared_checkpoints

ID = ["tbl", "key", "nanos", "logical"]


def fresh(staged: DataFrame, rows: DataFrame, seq: str = "seq") -> DataFrame:
    """What staging rows appends: the last of each clock and key, unless it is staged already."""
    return last_by_time_key(rows, seq=seq).join(staged.select(*ID), ID, "left_anti")


def unapplied(staged: DataFrame, applied: DataFrame) -> DataFrame:
    return staged.join(applied.select(*ID), ID, "left_anti")


filter_applied = unapplied

#: Fixed value: what stands in place of a mutation that was applied without having been staged.
STUB = '{"__stub__":true}'


def emitted(staged: DataFrame) -> DataFrame:
    """Staged mutations without stubs, which say only that something was applied. This package's logs hold none; those of other writers do."""
    return staged.where(F.col("data").isNull() | (F.regexp_replace("data", r"\s", "") != STUB))


def mark(applied: DataFrame, rows: DataFrame) -> DataFrame:
    """The applied log with rows marked; repeats add nothing."""
    return applied.unionByName(rows.select(*ID).distinct().join(applied, ID, "left_anti"))


def split_by_pending(staged: DataFrame, applied: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has something unapplied, which must queue behind it, and the others."""
    pending = unapplied(staged, applied).select("tbl", "key").distinct()
    return rows.join(pending, ["tbl", "key"], "left_semi"), rows.join(pending, ["tbl", "key"], "left_anti")


def overwrite(staged: DataFrame, rows: DataFrame) -> DataFrame:
    """Staged with queued rows put in place of rows of the same clock and key."""
    return staged.join(rows.select(*ID), ID, "left_anti").unionByName(rows.select(*staged.columns))


def page(staged: DataFrame, applied: DataFrame, after: tuple[int, int, str], end: tuple[int, int], limit: int) -> DataFrame:
    """The next rows behind a cursor (clock, key) and before a clock, in order."""
    at = hlc.literal(after[0], after[1])
    here = hlc.pair()
    later = hlc.less(at, here) | ((here[0] == at[0]) & (here[1] == at[1]) & (F.col("key") > after[2]))
    rows = staged.where(F.col("nanos").between(after[0], end[0]) & later & hlc.less(here, hlc.literal(*end)))
    return unapplied(rows, applied).orderBy("nanos", "logical", "key", "tbl").limit(limit)


def count_unapplied(staged: DataFrame, applied: DataFrame, before: tuple[int, int]) -> DataFrame:
    rows = staged.where(hlc.less(hlc.pair(), hlc.literal(*before)))
    return unapplied(rows, applied).agg(F.count("*").alias("n"))


def retire(staged: DataFrame, applied: DataFrame, through: tuple[int, int]) -> DataFrame:
    """Staged without applied rows up to and including a clock."""
    old = applied.where(hlc.at_most(hlc.pair(), hlc.literal(*through)))
    return staged.join(old.select(*ID), ID, "left_anti")


def by_time(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables' mutations as one log, ordered by clock, table and key."""
    parts = [df.withColumn("tbl", F.lit(name)) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("nanos", "logical", "tbl", "key")


def transactions(log: DataFrame) -> DataFrame:
    """Source transactions of a log: clock, number of tables and of mutations."""
    return log.groupBy("nanos", "logical").agg(F.countDistinct("tbl").alias("n_tables"), F.count("*").alias("n_rows"))


FLUSHED = "nanos long, logical int, n_tables long, n_rows long, flush long"


def _next_flush(sums: np.ndarray, size: int, carried: np.ndarray) -> np.ndarray:
    """With so many mutations waiting, how many transactions are taken until a flush; more than there are if none comes."""
    return np.searchsorted(sums, size - carried) + 1


def _outcomes(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each number of mutations that may wait before these transactions, 0 to size - 1: how many flushes come, and how many wait after them."""
    sums, n = np.cumsum(rows), len(rows)
    total = np.concatenate(([0], sums))
    # from each place where a flush has just been, the next such place, from the end backwards
    after = np.searchsorted(sums, total + size) + 1
    flushes, left = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for k in range(n, -1, -1):
        if after[k] <= n:
            flushes[k], left[k] = flushes[after[k]] + 1, left[after[k]]
        else:
            left[k] = total[n] - total[k]
    carried = np.arange(size)
    first = _next_flush(sums, size, carried)
    none = first > n
    there = np.minimum(first, n)
    return np.where(none, 0, flushes[there] + 1), np.where(none, carried + total[n], left[there])


def flush_groups(log: DataFrame, size: int) -> DataFrame:
    """Transactions with the number of the flush they go out in: whole transactions, a flush as soon as `size` mutations wait, none waiting after it.

    Where a flush comes depends on the one before. So transactions are dealt out by ranges of their clock, each range says what it would make
    of any number of mutations waiting before it (arrays of `size` numbers come to the driver, one a partition), and numbers its flushes when that is known.
    """
    shared_checkpoints(log.sparkSession)
    tx = transactions(log).repartitionByRange("nanos", "logical").sortWithinPartitions("nanos", "logical").checkpoint()

    def outcomes(frames):
        rows = [f["n_rows"].to_numpy() for f in frames]
        flushes, left = _outcomes(np.concatenate([np.zeros(0, np.int64), *rows]), size)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "flushes": [flushes.tolist()], "left": [left.tolist()]})

    known, waiting, number = {}, 0, 0
    for r in sorted(tx.mapInPandas(outcomes, "part int, flushes array<long>, left array<long>").collect()):
        known[r.part] = (waiting, number)
        number, waiting = number + r.flushes[waiting], r.left[waiting]

    def numbered(frames):
        waiting, number = known[TaskContext.get().partitionId()]
        for f in frames:
            sums = np.cumsum(f["n_rows"].to_numpy())
            made, at, base = np.zeros(len(f), np.int64), 0, 0
            while at < len(f):
                end = int(_next_flush(sums, size, np.array(waiting - base)))
                made[at:end] = number
                if end > len(f):
                    waiting += int(sums[-1]) - base
                    break
                at, base, waiting, number = end, int(sums[end - 1]), 0, number + 1
            yield f.assign(flush=made)

    return tx.mapInPandas(numbered, FLUSHED)


def by_table(log: DataFrame) -> DataFrame:
    """Mutations of all times coalesced by table: number, first and last clock."""
    clock = F.struct("nanos", "logical")
    out = log.groupBy("tbl").agg(F.count("*").alias("n_rows"), F.min(clock).alias("lo"), F.max(clock).alias("hi"))
    return out.select("tbl", "n_rows", F.col("lo.nanos").alias("first_nanos"), F.col("lo.logical").alias("first_logical"), F.col("hi.nanos").alias("last_nanos"), F.col("hi.logical").alias("last_logical"))
