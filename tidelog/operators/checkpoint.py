"""Checkpoints of source partitions: (grp, part, nanos, logical, applied), and the window that may be applied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import hlc

#: What a partition that was just added counts as having applied.
SEED = (1, 1)


def _clock(c: str = ""):
    return F.struct(F.col(f"{c}nanos").alias("nanos"), F.col(f"{c}logical").alias("logical"))


def going_backwards(log: DataFrame, new: DataFrame) -> DataFrame:
    """New checkpoints below the last one of their partition."""
    last = log.groupBy("grp", "part").agg(F.max(_clock()).alias("last"))
    return new.join(last, ["grp", "part"]).where(_clock() < F.col("last")).select(*new.columns)


def advance(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new checkpoints; one that goes backwards is an error, one that repeats the last adds nothing."""
    last = log.groupBy("grp", "part").agg(F.max(_clock()).alias("last"))
    judged = new.join(last, ["grp", "part"], "left")
    message = F.concat(F.lit("going backwards: "), hlc.text(F.col("nanos"), F.col("logical")))
    checked = judged.withColumn("nanos", F.when(F.col("last").isNull() | (_clock() >= F.col("last")), F.col("nanos")).otherwise(F.raise_error(message).cast("long")))
    return log.unionByName(checked.where(F.col("last").isNull() | (_clock() > F.col("last"))).select(*log.columns))


def commit(log: DataFrame, applied: hlc.Range) -> DataFrame:
    """The log with all checkpoints in the range marked as applied."""
    return log.withColumn("applied", F.col("applied") | applied.contains())


def ensure(log: DataFrame, partitions: DataFrame) -> DataFrame:
    """The log with a seed for every partition (grp, part) that it lacks."""
    new = partitions.select("grp", "part").distinct().join(log, ["grp", "part"], "left_anti")
    return log.unionByName(new.select("grp", "part", F.lit(SEED[0]).cast("long").alias("nanos"), F.lit(SEED[1]).cast("int").alias("logical"), F.lit(True).alias("applied")).select(*log.columns))


def refresh(log: DataFrame) -> DataFrame:
    """For each group the window (low, high): from the last applied checkpoint before the first gap to the slowest partition's last one.

    high is the least over partitions of their greatest checkpoint. low is the greatest applied checkpoint that
    has no unapplied one before it; (0, 0) if there is none.
    """
    rows = log.select("grp", "part", "applied", _clock().alias("c"))
    ends = rows.groupBy("grp", "part").agg(F.max("c").alias("last")).groupBy("grp").agg(F.min("last").alias("high"))
    gaps = rows.groupBy("grp").agg(F.min(F.when(~F.col("applied"), F.col("c"))).alias("gap"))
    low = rows.join(gaps, "grp").where(F.col("applied") & (F.col("gap").isNull() | (F.col("c") < F.col("gap")))).join(ends, "grp").where(F.col("c") <= F.col("high"))
    low = low.groupBy("grp").agg(F.max("c").alias("low"))
    out = ends.join(low, "grp", "left")
    zero = F.struct(F.lit(0).cast("long").alias("nanos"), F.lit(0).alias("logical"))
    low = F.coalesce("low", zero)
    return out.select("grp", low["nanos"].alias("low_nanos"), low["logical"].alias("low_logical"), F.col("high.nanos").alias("high_nanos"), F.col("high.logical").alias("high_logical"))


def compact(log: DataFrame) -> DataFrame:
    """The log without checkpoints that no window depends on: each group's low end, what isn't applied and each partition's last one stay."""
    ends = log.groupBy("grp", "part").agg(F.max(_clock()).alias("last"))
    low = refresh(log).select("grp", F.struct(F.col("low_nanos").alias("nanos"), F.col("low_logical").alias("logical")).alias("low"))
    kept = log.join(ends, ["grp", "part"]).join(low, "grp").where(~F.col("applied") | (_clock() == F.col("last")) | (_clock() == F.col("low")))
    return kept.select(*log.columns).distinct()


def unapplied_groups(log: DataFrame) -> DataFrame:
    return log.where(~F.col("applied")).select("grp").distinct()


def common_progress(progress: DataFrame, tables: DataFrame) -> DataFrame:
    """The clock that all tables (tbl) have reached; no row while one of them has no progress."""
    last = progress.groupBy("tbl").agg(F.max(_clock()).alias("c"))
    joined = tables.select("tbl").distinct().join(last, "tbl", "left")
    out = joined.agg(F.min("c").alias("c"), F.count("*").alias("n"), F.count("c").alias("known"))
    return out.where((F.col("n") > 0) & (F.col("n") == F.col("known"))).select(F.col("c.nanos").alias("nanos"), F.col("c.logical").alias("logical"))
