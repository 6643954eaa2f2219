"""Keys that failed, and what they hold up."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Full(RuntimeError):
    """More keys are poisoned than may be."""


class PoisonSet:
    """Failed keys of one sweep; a batch that touches one is held back, and all its keys are poisoned with it."""

    def __init__(self, cap: int = 10_000):
        self.cap = cap
        self.keys: set = set()

    @property
    def full(self) -> bool:
        return len(self.keys) >= self.cap

    def mark(self, keys) -> None:
        self.keys |= set(keys)
        if len(self.keys) > self.cap:
            raise Full(f"{len(self.keys)} keys")

    def touches(self, keys) -> bool:
        """Whether the batch is held back; if so its keys are poisoned."""
        keys = set(keys)
        if self.keys.isdisjoint(keys):
            return False
        self.keys |= keys
        return True


def shared_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable: a folder is made only where none is set, which only a session on one machine may do."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidelog-checkpoints-"))


def spread(batches: DataFrame, poisoned: DataFrame, rounds: int | None = None) -> DataFrame:
    """Batches (batch, key) held back by poisoned (key, since): those that touch a key poisoned in an earlier batch, and, each round, those that touch keys of batches held back.

    The fold over ordered batches as joins: without rounds they go on, each checkpointed, until no key is poisoned anew or earlier,
    which gives what PoisonSet gives; with rounds, chains longer than those are cut.
    """
    kind = batches.schema["batch"].dataType  # batches are numbers in order
    bad = poisoned.groupBy("key").agg(F.min(F.col("since").cast(kind)).alias("since"))
    if rounds is None:
        shared_checkpoints(batches.sparkSession)
    done, seen = 0, None
    while done != rounds:
        held = batches.join(bad, "key").where(F.col("batch") >= F.col("since")).select("batch").distinct()
        more = batches.join(held, "batch").select("key", F.col("batch").alias("since"))
        bad = bad.union(more).groupBy("key").agg(F.min("since").alias("since"))
        done += 1
        if rounds is None:
            bad = bad.checkpoint()
            state = bad.agg(F.count("*").alias("n"), F.sum(F.col("since").cast("decimal(38,0)")).alias("s")).first()
            if seen == state:
                break
            seen = state
    return batches.join(bad, "key").where(F.col("batch") >= F.col("since")).select("batch").distinct()
