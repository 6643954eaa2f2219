"""Whether mutations are applied at once or in consistent order, and how one micro-batch is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import hlc
from tidelog.operators import resolve, staging
from tidelog.operators.dedup import last_by_key

BEST_EFFORT, CONSISTENT, IMMEDIATE = "best_effort", "consistent", "immediate"


def next_mode(current: str | None, lag: float, window: float) -> str:
    """Best effort from a lag of the window on, consistent up to a quarter of it; between them what it was, best effort at first."""
    if window <= 0 or lag <= window / 4:
        return CONSISTENT
    if lag >= window:
        return BEST_EFFORT
    return current or BEST_EFFORT


def mode_column(current: Column, lag: Column, window: Column) -> Column:
    decided = F.when((window <= 0) | (lag <= window / 4), CONSISTENT).when(lag >= window, BEST_EFFORT)
    return F.coalesce(decided, current, F.lit(BEST_EFFORT))


def debounce(rows: DataFrame, applied: DataFrame) -> DataFrame:
    """Rows that weren't applied before."""
    return staging.filter_applied(rows, applied)


def consistent_batch(staged: DataFrame, applied: DataFrame, window: hlc.Range) -> DataFrame:
    """The last mutation of each key among whole source transactions in the window."""
    rows = staging.unapplied(staged.where(window.contains()), applied)
    return last_by_key(rows.withColumn("seq", F.lit(0).cast("long")) if "seq" not in rows.columns else rows)


def best_effort_batch(staged: DataFrame, applied: DataFrame, rows: DataFrame, parents: DataFrame | None = None, reference: str = "parent", parent_key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows to apply now, rows to stage): a key with something staged queues behind it, and so does a row without its parent."""
    queued, free = staging.split_by_pending(staged, applied, rows)
    if parents is None:
        return free, queued
    known = parents.select(F.col(parent_key).alias(reference)).distinct()
    alone = free.where(F.col(reference).isNotNull()).join(known, reference, "left_anti").select(*rows.columns)
    stuck = alone.select("tbl", "key").distinct()  # later rows of a key that failed queue as well
    return free.join(stuck, ["tbl", "key"], "left_anti"), queued.unionByName(free.join(stuck, ["tbl", "key"], "left_semi").select(*rows.columns))


def apply_batch(target: DataFrame, rows: DataFrame, keys: list[str], cas: list[str] = (), deadlines: dict[str, str] | None = None, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(new target, conflicts) of one batch of mapped mutations: deletes without condition, writes by compare-and-set and deadlines."""
    made = resolve.apply_once(target, last_by_key(rows), keys, list(cas), deadlines, as_of, is_delete="is_delete")
    return made.applied, made.conflicts


def in_order(batch: dict[str, DataFrame], levels: list[list[str]]) -> list[tuple[str, DataFrame]]:
    """A batch's tables, parents before children."""
    return [(t, batch[t]) for level in levels for t in level if t in batch]


def retirement(min_nanos: int, keep_seconds: int = 24 * 3600) -> tuple[int, int]:
    """The clock through which applied rows may be retired."""
    return max(0, min_nanos - keep_seconds * 1_000_000_000), 0
