"""Several tables and logs in a folder that change together, by one rename for each step."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from tidelog.streaming.table import _Folder

FORMAT = 2
#: Jobs of one step that run side by side; most are small.
WRITERS = 4
#: The column that rows are dealt to folders by.
BUCKET = "__bucket"


@dataclass
class Store:
    """Tables are snapshots, of which a step rewrites the buckets that it touches; logs are a base and what was appended since.

    A step writes its snapshots and appendices under its number, then a commit that names what counts. Whatever a
    failed step left behind is overwritten by the step that takes its number.
    """

    spark: SparkSession
    path: str
    tables: dict[str, T.StructType]
    logs: dict[str, T.StructType] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.folder = _Folder(self.spark, self.path)

    def last(self) -> dict:
        names = self.folder.names("commit-")
        last = json.loads(self.folder.read(names[-1])) if names else {"format": FORMAT, "step": -1, "tables": {}, "logs": {}, "meta": {}}
        if last["format"] != FORMAT:
            raise ValueError(f"{self.path} has format {last['format']}, this is {FORMAT}")
        return last

    def read(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """A table or log; of a table all rows, or those of some buckets."""
        last = self.last()
        if name in self.logs:
            kept = last["logs"].get(name, {"base": None, "steps": []})
            paths = ([kept["base"]] if kept["base"] else []) + [f"{name}/step={s}" for s in kept["steps"]]
            schema = self.logs[name]
        else:
            known = last["tables"].get(name, {})
            paths = [path for b, path in known.items() if buckets is None or b == "" or int(b) in buckets]
            schema = self.tables[name]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in paths))

    def _write(self, writes: list[tuple[DataFrameWriter, str]]) -> None:
        """Writes to folders, several at once; the first error counts, after all have ended."""
        with ThreadPoolExecutor(WRITERS) as pool:
            write = inheritable_thread_target(self.spark)(lambda writer, folder: writer.mode("overwrite").parquet(f"{self.path}/{folder}"))
            for done in [pool.submit(write, *w) for w in writes]:
                done.result()

    def commit(self, tables: dict[str, DataFrame] | None = None, appended: dict[str, DataFrame] | None = None, compacted: dict[str, DataFrame] | None = None, meta: dict | None = None, touched: dict[str, tuple[Column, list[int]]] | None = None) -> int:
        """One step: new states of tables, rows for logs, logs rewritten as a whole, and facts to remember. Returns its number.

        A table in touched has the buckets of that list alone in its new state, by that column; its others stay as they are.
        """
        last = self.last()
        step = last["step"] + 1
        writes = []
        for name, df in (tables or {}).items():
            rows, folder = df.select(*self.tables[name].names), f"{name}/v={step}"
            if name not in (touched or {}):
                writes.append((rows.write, folder))
                last["tables"][name] = {"": folder}
            else:
                writes.append((rows.withColumn(BUCKET, touched[name][0]).repartition(BUCKET).write.partitionBy(BUCKET), folder))
        for name, df in (compacted or {}).items():
            writes.append((df.select(*self.logs[name].names).write, f"{name}/base={step}"))
            last["logs"][name] = {"base": f"{name}/base={step}", "steps": []}
        for name, df in (appended or {}).items():
            writes.append((df.select(*self.logs[name].names).write, f"{name}/step={step}"))
            last["logs"].setdefault(name, {"base": None, "steps": []})["steps"].append(step)
        self._write(writes)
        for name, (_, numbers) in (touched or {}).items():
            folder = f"{name}/v={step}"
            written = {n.split("=")[1]: f"{folder}/{n}" for n in self.folder.names(f"{BUCKET}=", folder)}
            kept = {b: path for b, path in last["tables"].get(name, {}).items() if int(b) not in numbers}
            last["tables"][name] = kept | written
        last |= {"step": step, "meta": last["meta"] | (meta or {})}
        self.folder.create(f"commit-{step:020d}", json.dumps(last))
        return step
