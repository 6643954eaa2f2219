"""Keeping one mutation of several with the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of greatest order for each key.

    An aggregate, not a window: it combines before the shuffle, so a key that has a third of all rows
    costs one row a partition.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)


def last_by_key(df: DataFrame, keys: list[str] = ("tbl", "key"), seq: str = "seq") -> DataFrame:
    """Of each key the mutation of greatest clock, the later one in seq on a tie. Null keys are an error."""
    checked = [F.coalesce(F.col(k), F.raise_error(F.lit(f"{k} is null")).cast(df.schema[k].dataType)).alias(k) if k in keys else F.col(k) for k in df.columns]
    return _last(df.select(*checked), list(keys), ["nanos", "logical", seq])


def last_by_time_key(df: DataFrame, keys: list[str] = ("tbl", "key"), seq: str = "seq") -> DataFrame:
    """Of each clock and key the mutation that comes last."""
    return _last(df, [*keys, "nanos", "logical"], [seq])
