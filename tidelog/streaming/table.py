"""A target table as snapshots in a folder, and a stream that writes it once for each batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

FORMAT = 1


class _Folder:
    """Files through Hadoop's file system, so that any store works that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self.jvm, self.root = jvm, jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Writes to a name of its own, then renames, so that readers see all of it or none."""
        part = self.path(f"_{name}.part")
        out = self.fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(part, self.path(name)):
            raise OSError(f"{name} exists already")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), False)

    def names(self, prefix: str, folder: str | None = None) -> list[str]:
        place = self.path(folder) if folder else self.root
        if not self.fs.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place) if s.getPath().getName().startswith(prefix))


@dataclass
class SnapshotTable:
    """Snapshots `v=<batch>` and commits `commit-<batch>`; the last commit names the snapshot that counts.

    A batch's snapshot is written, then committed by one rename. A replayed batch that was committed does
    nothing; one that failed before its commit is written again. Logs (applied, dead letters) are tagged with the batch, and rows of
    batches without a commit don't count.
    """

    spark: SparkSession
    path: str
    schema: T.StructType

    def __post_init__(self) -> None:
        self.folder = _Folder(self.spark, self.path)

    def last(self) -> dict | None:
        names = self.folder.names("commit-")
        return json.loads(self.folder.read(names[-1])) if names else None

    def read(self) -> DataFrame:
        last = self.last()
        if last is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{last['snapshot']}")

    def write(self, batch: int, state: DataFrame, logs: dict[str, DataFrame] | None = None) -> bool:
        """Commits a batch; False if it was committed before."""
        last = self.last()
        if last is not None and last["batch"] >= batch:
            return False
        name = f"v={batch}"
        state.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/{name}")
        for log, rows in (logs or {}).items():
            rows.write.mode("overwrite").parquet(f"{self.path}/log-{log}/batch={batch}")
        self.folder.create(f"commit-{batch:020d}", json.dumps({"format": FORMAT, "batch": batch, "snapshot": name}))
        return True

    def log(self, name: str, schema: str) -> DataFrame:
        """Rows of a log from committed batches."""
        last = self.last()
        if last is None or not self.folder.fs.exists(self.folder.path(f"log-{name}")):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        rows = self.spark.read.option("basePath", f"{self.path}/log-{name}").schema(f"{schema}, batch long").parquet(f"{self.path}/log-{name}")
        return rows.where(F.col("batch") <= last["batch"])


def write_stream(stream: DataFrame, table: SnapshotTable, checkpoint: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, dict[str, DataFrame]]], trigger: dict | None = None) -> StreamingQuery:
    """Applies each micro-batch by step(target, batch), which gives the new target and logs; each batch counts once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        last = table.last()
        if last is not None and last["batch"] >= batch_id:
            return
        kept = batch.persist()
        try:
            state, logs = step(table.read(), kept)
            table.write(batch_id, state, logs)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def discard(df: DataFrame) -> None:
    """Reads everything and drops it."""
    df.write.format("noop").mode("overwrite").save()
