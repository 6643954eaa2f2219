"""A deterministic workload of parents and children, and its checker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def steps(spark: SparkSession, n: int) -> DataFrame:
    """(seq, nanos, logical, tbl, key, id, parent, val): in turns a new parent, an update of one, a child of an old parent, a child of a new one, and a child that changes its parent."""
    s = spark.range(n).withColumnRenamed("id", "seq")
    turn, cycle = F.col("seq") % 5, F.floor(F.col("seq") / 5)
    old = F.floor(cycle / 2)
    tbl = F.when(turn < 2, "parent").otherwise("child")
    ident = F.when(turn == 0, cycle).when(turn == 1, old).when(turn == 2, 2 * cycle).when(turn == 3, 2 * cycle + 1).otherwise(2 * old)
    parent = F.when(turn == 2, old).when(turn >= 3, cycle)
    out = s.select("seq", (F.col("seq") + 1).alias("nanos"), F.lit(0).alias("logical"), tbl.alias("tbl"), ident.cast("long").alias("id"), parent.cast("long").alias("parent"), (F.col("seq") * 7 % 1000).alias("val"))
    return out.withColumn("key", F.concat(F.lit("["), F.col("id").cast("string"), F.lit("]")))


def check(parents: DataFrame, children: DataFrame, expected_parents: DataFrame, expected_children: DataFrame) -> DataFrame:
    """(what, n): rows missing, extra and changed in both tables, and children without a parent; all zero where all is well."""
    from tidelog.operators.target import difference
    from tidelog.plans.catalog import orphans

    found = difference(expected_parents, parents, ["id"]).select(F.concat(F.lit("parent "), F.col("difference")).alias("what"))
    found = found.union(difference(expected_children, children, ["id"]).select(F.concat(F.lit("child "), F.col("difference"))))
    found = found.union(orphans(children, parents, "parent", "id").select(F.lit("child orphan")))
    return found.groupBy("what").agg(F.count("*").alias("n"))
