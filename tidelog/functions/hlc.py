"""Hybrid logical clock: a pair (nanos LONG, logical INT) with a total order, as columns.

Pairs are compared by an expanded predicate on both columns, never as structs, so that scans can
push the part on nanos down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LOGICAL = 2147483647


def less(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return (a[0] < b[0]) | ((a[0] == b[0]) & (a[1] < b[1]))


def at_most(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return (a[0] < b[0]) | ((a[0] == b[0]) & (a[1] <= b[1]))


def pair(nanos: str = "nanos", logical: str = "logical") -> tuple[Column, Column]:
    return F.col(nanos), F.col(logical)


def literal(nanos: int, logical: int = 0) -> tuple[Column, Column]:
    return F.lit(nanos).cast("long"), F.lit(logical).cast("int")


def text(nanos: Column, logical: Column) -> Column:
    """`nanos.logical`, the logical part in ten digits."""
    return F.concat(nanos.cast("string"), F.lit("."), F.lpad(logical.cast("string"), 10, "0"))


def parse(value: Column) -> Column:
    """(nanos, logical) of a text, null unless it is well formed.

    One dot, digits on both sides, both in range; the right side has ten digits or is zero.
    """
    nanos = F.regexp_extract(value, r"^([0-9]+)\.[0-9]+$", 1).try_cast("long")
    right = F.regexp_extract(value, r"^[0-9]+\.([0-9]+)$", 1)
    logical = right.try_cast("int")
    fine = nanos.isNotNull() & logical.isNotNull() & ((F.length(right) == 10) | (logical == 0))
    return F.when(fine, F.struct(nanos.alias("nanos"), logical.alias("logical")))


def before(nanos: Column, logical: Column) -> Column:
    """The largest clock below this one."""
    step = logical > 0
    return F.struct(F.when(step, nanos).otherwise(nanos - 1).alias("nanos"), F.when(step, logical - 1).otherwise(F.lit(MAX_LOGICAL)).cast("int").alias("logical"))


def after(nanos: Column, logical: Column) -> Column:
    """The smallest clock above this one."""
    carry = logical == MAX_LOGICAL
    return F.struct(F.when(carry, nanos + 1).otherwise(nanos).alias("nanos"), F.when(carry, F.lit(0)).otherwise(logical + 1).cast("int").alias("logical"))


def resolved_name(digits: Column) -> Column:
    """Clock of a resolved marker: YYYYMMDDHHMMSS, nine digits of nanoseconds, ten of the logical part."""
    part = lambda start: F.substring(digits, start, 2).cast("long")
    days = F.datediff(F.to_date(F.substring(digits, 1, 8), "yyyyMMdd"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = days * 86400 + part(9) * 3600 + part(11) * 60 + part(13)  # UTC in any session
    return F.struct((seconds * 1000000000 + F.substring(digits, 15, 9).cast("long")).alias("nanos"), F.substring(digits, 24, 10).cast("int").alias("logical"))


@dataclass(frozen=True)
class Range:
    """Clocks from low up to but not including high."""

    low: tuple[int, int] = (0, 0)
    high: tuple[int, int] = (0, 0)

    @staticmethod
    def including(low: tuple[int, int], high: tuple[int, int]) -> Range:
        nanos, logical = high
        return Range(low, (nanos + 1, 0) if logical == MAX_LOGICAL else (nanos, logical + 1))

    @property
    def empty(self) -> bool:
        return self.low >= self.high

    def contains(self, nanos: str = "nanos", logical: str = "logical") -> Column:
        p = pair(nanos, logical)
        # the part on nanos alone reaches the scan
        return F.col(nanos).between(self.low[0], self.high[0]) & at_most(literal(*self.low), p) & less(p, literal(*self.high))

    def holds(self, clock: tuple[int, int]) -> bool:
        return self.low <= clock < self.high

    def with_min(self, low: tuple[int, int]) -> Range:
        return Range(low, max(low, self.high))

    def extend(self, clock: tuple[int, int]) -> Range:
        return Range(self.low, max(self.high, Range.including(clock, clock).high))

    @property
    def last(self) -> tuple[int, int]:
        """The largest clock inside."""
        nanos, logical = self.high
        return (nanos, logical - 1) if logical else (nanos - 1, MAX_LOGICAL)
