"""Leases, memos, retries, metrics: what keeps a run in order besides its data."""

from __future__ import annotations

import json
import random
import time
import uuid
from collections import deque
from collections.abc import Callable, Hashable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.target import upsert
from tidelog.streaming.table import SnapshotTable

#: HTTP answers after which another try may succeed.
TRANSIENT = frozenset({429, 500, 502, 504})


# ---------------------------------------------------------------- leases


def acquire(leases: DataFrame, proposed: DataFrame, now: Column) -> DataFrame:
    """Proposed leases (name, expires, nonce) that nobody else holds: no lease of the name, one that is over, or the same nonce."""
    blocking = leases.where(F.col("expires") > now).select("name", F.col("nonce").alias("__held"))
    return proposed.join(blocking, "name", "left").where(F.col("__held").isNull() | (F.col("__held") == F.col("nonce"))).drop("__held")


@dataclass
class Lease:
    """A lease on a name as a file in a shared folder, made by one rename; its age is what it says, so clocks must agree roughly."""

    table: SnapshotTable
    name: str
    seconds: float = 30.0
    nonce: str = field(default_factory=lambda: uuid.uuid4().hex)

    def try_take(self, now: float | None = None) -> bool:
        """Takes the lease, or goes on with it once half of it is over; False if another one has it."""
        now = time.time() if now is None else now
        folder, prefix = self.table.folder, f"lease-{self.name}-"
        names = [n for n in folder.names(prefix) if n[len(prefix):].isdigit()]
        if names:
            held = json.loads(folder.read(names[-1]))
            if held["expires"] > now and held["nonce"] != self.nonce:
                return False
            if held["nonce"] == self.nonce and held["expires"] - now > self.seconds / 2:
                return True
        turn = int(names[-1][len(prefix):]) + 1 if names else 0
        try:
            folder.create(f"{prefix}{turn:020d}", json.dumps({"nonce": self.nonce, "expires": now + self.seconds}))
        except OSError:
            return False  # another one took this turn
        for old in names[:-1]:  # the last one stays, for those that read it just now
            folder.remove(old)
        return True

    def release(self) -> None:
        """Lets others have it at once, if it is held here."""
        folder, prefix = self.table.folder, f"lease-{self.name}-"
        names = [n for n in folder.names(prefix) if n[len(prefix):].isdigit()]
        if names and json.loads(folder.read(names[-1]))["nonce"] == self.nonce:
            folder.create(f"{prefix}{int(names[-1][len(prefix):]) + 1:020d}", json.dumps({"nonce": self.nonce, "expires": 0.0}))


class Busy(RuntimeError):
    """Another one holds the lease."""


# ---------------------------------------------------------------- memo


@dataclass
class Memo:
    """A small table of values by key; each put is a batch of its own."""

    table: SnapshotTable

    @staticmethod
    def at(spark: SparkSession, path: str) -> Memo:
        return Memo(SnapshotTable(spark, path, spark.createDataFrame([], "key string, value binary").schema))

    def put(self, key: str, value: bytes) -> None:
        row = self.table.spark.createDataFrame([(key, bytearray(value))], self.table.schema)
        last = self.table.last()
        self.table.write(0 if last is None else last["batch"] + 1, upsert(self.table.read(), row, ["key"]))

    def get(self, key: str) -> bytes | None:
        row = self.table.read().where(F.col("key") == key).first()
        return None if row is None else bytes(row.value)


# ---------------------------------------------------------------- retries


def retry(call: Callable, again: Callable[[Exception], bool], attempts: int = 10, first: float = 0.1, longest: float = 10.0, sleep: Callable[[float], None] = time.sleep):
    """call() until it succeeds, fails with an error that isn't worth another try, or has failed too often; waits double, with some chance in them."""
    wait = first
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as error:
            if attempt == attempts or not again(error):
                raise
            sleep(wait * random.uniform(0.5, 1.0))
            wait = min(longest, 2 * wait)


def transient(error: Exception) -> bool:
    return isinstance(error, OSError) or getattr(error, "status", None) in TRANSIENT


# ---------------------------------------------------------------- scheduling


class Lockset:
    """Runs calls that name the keys they touch: those that share a key in the order they came, the others side by side."""

    def __init__(self, workers: int = 4):
        self.pool = ThreadPoolExecutor(workers)
        self.lock = Lock()
        self.queues: dict[Hashable, deque] = {}

    def schedule(self, keys: Iterable[Hashable], call: Callable[[], Any]) -> Future:
        """The call's future. It starts once it is first in line for each of its keys; one that fails lets the next go on."""
        task = (frozenset(keys), call, Future())
        with self.lock:
            for key in task[0]:
                self.queues.setdefault(key, deque()).append(task)
            ready = self._first(task)
        if ready:
            self.pool.submit(self._run, task)
        return task[2]

    def _first(self, task: tuple) -> bool:
        return all(self.queues[key][0] is task for key in task[0])

    def _run(self, task: tuple) -> None:
        keys, call, future = task
        try:
            result, error = call(), None
        except BaseException as failure:  # it is the future's to tell
            result, error = None, failure
        heirs = []
        with self.lock:
            for key in keys:
                self.queues[key].popleft()
                if not self.queues[key]:
                    del self.queues[key]
                elif self.queues[key][0] not in heirs:
                    heirs.append(self.queues[key][0])
            heirs = [t for t in heirs if self._first(t)]
        for heir in heirs:
            self.pool.submit(self._run, heir)
        if error is None:
            future.set_result(result)
        else:
            future.set_exception(error)

    def close(self, futures: Iterable[Future] = ()) -> None:
        """Waits for the calls, then for the workers."""
        wait(futures)
        self.pool.shutdown()


# ---------------------------------------------------------------- metrics


def observed(batch: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A batch that counts itself while it is used: mutations, deletes, first and last clock."""
    seen = Observation(name)
    clock = F.struct("nanos", "logical")
    return batch.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if("is_delete").alias("n_deletes"), F.min(clock)["nanos"].alias("first_nanos"), F.max(clock)["nanos"].alias("last_nanos")), seen


def describe(table: SnapshotTable) -> dict:
    """What a diagnostic needs to know of a table."""
    return {"path": table.path, "columns": table.schema.names, "last": table.last(), "commits": len(table.folder.names("commit-")), "logs": table.folder.names("log-")}
