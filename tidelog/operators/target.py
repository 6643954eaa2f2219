"""Writing rows to a target table, as a new state of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Custom strategies by name: functions of target, rows and keys that give the new target.
STRATEGIES: dict[str, Callable[[DataFrame, DataFrame, list[str]], DataFrame]] = {}


def strategy(name: str):
    def register(f):
        STRATEGIES[name] = f
        return f

    return register


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target with rows inserted or, by key, replaced; columns that rows lack keep their value, or null in new rows.

    A table of keys alone takes only new ones.
    """
    if set(target.columns) == set(keys):
        return target.unionByName(rows.select(*keys).distinct().join(target, keys, "left_anti"))
    lacking = [c for c in target.columns if c not in rows.columns]
    if lacking:
        rows = rows.join(target.select(*keys, *lacking), keys, "left")
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows.select(*target.columns))


def delete(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows' keys, whatever their values; absent keys don't matter."""
    return target.join(rows.select(*keys).distinct(), keys, "left_anti")


def apply(target: DataFrame, rows: DataFrame, keys: list[str], is_delete: str = "is_delete") -> DataFrame:
    """One batch of deduplicated mutations in a single pass over the target: rows that are touched go, those that aren't deletes come."""
    left = target.join(rows.select(*keys), keys, "left_anti")
    return left.unionByName(rows.where(~F.col(is_delete)).select(*target.columns))


def apply_custom(target: DataFrame, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    if name not in STRATEGIES:
        raise ValueError(f"no strategy {name}")
    return STRATEGIES[name](target, rows, keys)


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on which two tables differ: `missing` from b, `extra` in b, or `changed` values."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*values).alias("__a"), F.lit(1).alias("__in_a"))
    right = b.select(*keys, F.struct(*values).alias("__b"), F.lit(1).alias("__in_b"))
    what = F.when(F.col("__in_b").isNull(), "missing").when(F.col("__in_a").isNull(), "extra").when(~F.col("__a").eqNullSafe(F.col("__b")), "changed")
    return left.join(right, keys, "full").select(*keys, what.alias("difference")).where(F.col("difference").isNotNull())
