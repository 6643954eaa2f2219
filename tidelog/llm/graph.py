"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import compact, few_partitions, shared_checkpoints


def components(edges: DataFrame, at_most: int | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b: long) reaches; nodes without edges aren't listed.

    Alternates large-star and small-star rounds until the edges stop changing, which
    takes a number of rounds that grows with the logarithm of the longest path. Each round's edges are
    checkpointed in the shared folder, so that plans stay short and lost executors cost nothing.
    Only one count and one sum come to the driver. There are at_most so many edges, if that is known.
    """
    shared_checkpoints(edges.sparkSession)
    e = compact(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), at_most)
    seen = None
    for _ in range(max_rounds):
        # large star: neighbours larger than the node go to the smallest neighbour or the node
        both = _with(e, F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = e.groupBy("a").agg(F.min("b").alias("low"))
        e = e.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b")).where("a <> b").distinct().checkpoint()
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen == (state.n, state.s):
            break
        seen = (state.n, state.s)
        e = few_partitions(e, state.n)
    else:
        raise RuntimeError(f"edges still change after {max_rounds} rounds")
    e = few_partitions(e, state.n)
    return _with(e, F.struct(F.col("a").alias("node"), F.col("b").alias("component")), F.struct(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _with(e: DataFrame, *rows: Column) -> DataFrame:
    """So many rows of each one; unlike a union it keeps partitions."""
    return e.select(F.explode(F.array(*rows)).alias("e")).select("e.*")
