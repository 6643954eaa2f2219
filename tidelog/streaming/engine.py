"""The engine: mutations in, target tables out, in one of three modes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import hlc
from tidelog.operators import checkpoint, hooks, mapping, poison, resolve, staging
from tidelog.operators import target as sink
from tidelog.operators.dedup import last_by_key
from tidelog.plans import catalog
from tidelog.plans.catalog import Catalog, Table
from tidelog.plans.config import SourceConfig, TableConfig
from tidelog.sources import objects
from tidelog.streaming import control, modes
from tidelog.streaming.store import Store

MUTATION = "tbl string, key string, data string, before string, nanos bigint, logical int, seq bigint, is_delete boolean"
APPLIED = "tbl string, key string, nanos bigint, logical int"
CHECKPOINT = "grp string, part string, nanos bigint, logical int, applied boolean"
DEAD_LETTER = "dlq_name string, source_nanos bigint, source_logical int, data_after string, data_before string"


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


@dataclass
class Engine:
    """One group of tables with its staging, checkpoints and dead letters in a folder.

    `accept` takes micro-batches of mutations, each once by its number. In immediate mode they are applied at once; in
    best-effort mode what can be applied is, and the rest is staged; in consistent mode all is staged, and
    `sweep` applies whole source transactions up to the slowest partition's checkpoint. Each call commits everything it changes together.

    A mutation that its table can't take fails an immediate batch. In best-effort mode it is staged, with all later ones of its key.
    In a sweep its transaction waits, with all that touch a key of one that waits or refer to a row in one, and checkpoints
    don't count as applied until none does. Calls whose commit is lost are made again, a few times.
    """

    spark: SparkSession
    path: str
    catalog: Catalog
    configs: dict[str, TableConfig] = field(default_factory=dict)
    source: SourceConfig = field(default_factory=SourceConfig)
    #: Child to (its column, parent).
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    group: str = "group"
    mode: str = modes.CONSISTENT
    #: Seconds of lag from which on the engine goes over to best effort; None leaves the mode as it is.
    window: float | None = None
    #: Into how many buckets a table's rows are dealt by their keys; a commit rewrites those that it touches.
    buckets: int = 16
    #: How often a call is made at most if its files can't be written.
    attempts: int = 3
    #: For how long a call claims the folder for this engine; None lets any number of engines try.
    lease_seconds: float | None = None
    #: More failed keys than this stop a sweep.
    poison_cap: int = 10_000

    def __post_init__(self) -> None:
        self.levels = self.catalog.levels()
        for name, config in self.configs.items():
            config.check(self.catalog.tables[name])
        tables = {name: T.StructType([T.StructField(c.name, _schema(f"x {c.type}")[0].dataType) for c in t.columns]) for name, t in self.catalog.tables.items()}
        logs = {"staged": _schema(MUTATION), "applied": _schema(APPLIED), "dead_letters": _schema(DEAD_LETTER)}
        self.store = Store(self.spark, self.path, {**tables, "checkpoints": _schema(CHECKPOINT)}, logs)
        dealt = self._meta().get("buckets", self.buckets)
        if dealt != self.buckets:
            raise ValueError(f"{self.path} has {dealt} buckets, not {self.buckets}")
        self.lease = control.Lease(self.store, self.group, self.lease_seconds) if self.lease_seconds else None

    # -- reading

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def bounds(self) -> hlc.Range:
        """What may be applied now: after the last applied checkpoint, up to and including the slowest partition's."""
        row = checkpoint.refresh(self.store.read("checkpoints")).where(F.col("grp") == self.group).first()
        if row is None:
            return hlc.Range()
        return hlc.Range.including((row.low_nanos, row.low_logical), (row.high_nanos, row.high_logical))

    def _meta(self) -> dict:
        return self.store.last()["meta"]

    def position(self, source: str) -> str | None:
        """Where a source was when its last batch was taken."""
        return self._meta().get("positions", {}).get(source)

    def metrics(self) -> dict[str, dict[str, int]]:
        """For each table, of all batches: mutations received, deletes among them, mutations that had to wait, the last clock."""
        return self._meta().get("counts", {})

    # -- writing

    def _guarded(self, call: Callable[[], bool]) -> bool:
        """The call under the lease, again if its files couldn't be written."""
        def attempt() -> bool:
            if self.lease and not self.lease.try_take():
                raise control.Busy(f"{self.path}: another engine has {self.group}")
            return call()

        return control.retry(attempt, control.transient, self.attempts)

    def accept(
        self,
        batch: DataFrame,
        number: int,
        as_of: Column | None = None,
        positions: dict[str, str] | None = None,
        resolved: dict[str, tuple[int, int]] | None = None,
    ) -> bool:
        """Takes a batch; False if its number was taken before. Positions of sources and checkpoints of partitions commit with it."""
        return self._guarded(lambda: self._accept(batch, number, as_of, positions or {}, resolved or {}))

    def _accept(self, batch: DataFrame, number: int, as_of: Column | None, positions: dict, resolved: dict) -> bool:
        before = self._meta()
        if before.get("batch", -1) >= number:
            return False
        unknown = F.raise_error(F.concat(F.lit("no table "), F.coalesce("tbl", F.lit("of no name")))).cast("string")
        known = F.when(F.col("tbl").isin(list(self.catalog.tables)), F.col("tbl")).otherwise(unknown)
        rows = hooks.pipeline(batch, self.source, self.catalog).select(*_schema(MUTATION).names).withColumn("tbl", known).persist()
        try:
            counts, low, high = self._counted(rows, before.get("counts", {}))
            meta = {"batch": number, "counts": counts, "positions": before.get("positions", {}) | positions}
            tables = {"checkpoints": self._advanced(resolved)} if resolved else {}
            if self.mode == modes.CONSISTENT:
                staged = self.store.read("staged").where(F.col("nanos").between(low, high))
                self.store.commit(tables, {"staged": staging.fresh(staged, rows)}, meta=meta)
                return True
            # what was applied at other clocks can't be a repeat, so its files are passed over
            fresh = modes.debounce(rows, self.store.read("applied").where(F.col("nanos").between(low, high)))
            if self.mode == modes.IMMEDIATE:
                self._commit(fresh, {}, meta, as_of, tables)
                return True
            try:
                self._offer(fresh, None, meta, as_of, tables)
            except (ValueError, PySparkException):
                since = self._refused(fresh).groupBy("tbl", "key").agg(F.min(F.struct("nanos", "logical")).alias("__since")).persist()
                try:
                    if since.isEmpty():
                        raise
                    self._offer(fresh, since, meta, as_of, tables)
                finally:
                    since.unpersist()
            return True
        finally:
            rows.unpersist()

    def _counted(self, rows: DataFrame, before: dict) -> tuple[dict, int, int]:
        """Counts of tables with those of a batch added, and its first and last clock."""
        seen = rows.groupBy("tbl").agg(
            F.count("*").alias("n"), F.count_if("is_delete").alias("deletes"), F.min("nanos").alias("low"), F.max("nanos").alias("high")
        ).collect()  # a row a table
        counts = {name: dict(c) for name, c in before.items()}
        for r in seen:
            c = counts.setdefault(r.tbl, {"mutations": 0, "deletes": 0, "waited": 0, "last_nanos": 0})
            c |= {"mutations": c["mutations"] + r.n, "deletes": c["deletes"] + r.deletes, "last_nanos": max(c["last_nanos"], r.high or 0)}
        clocks = [(r.low, r.high) for r in seen if r.low is not None]
        return counts, min((c[0] for c in clocks), default=0), max((c[1] for c in clocks), default=0)

    def _offer(self, rows: DataFrame, since: DataFrame | None, meta: dict, as_of: Column | None, tables: dict[str, DataFrame]) -> None:
        """Applies what can be, and stages the rest: what its key's refusals hold up, what queues, what lacks a parent."""
        now, later = rows, None
        if since is not None:
            judged = rows.join(since, ["tbl", "key"], "left")
            held = F.coalesce(F.struct("nanos", "logical") >= F.col("__since"), F.lit(False))
            now, later = judged.where(~held).select(*rows.columns), judged.where(held).select(*rows.columns)
        for level in self.levels:
            for name in level:
                now, queued = self._split(now, name)
                later = queued if later is None else later.unionByName(queued)
        now, later = now.persist(), later.persist()
        try:
            counts = {name: dict(c) for name, c in meta["counts"].items()}
            for r in later.groupBy("tbl").agg(F.count("*").alias("n")).collect():  # a row a table
                counts[r.tbl]["waited"] += r.n
            self._commit(now, {"staged": staging.fresh(self.store.read("staged"), later)}, meta | {"counts": counts}, as_of, tables)
        finally:
            now.unpersist()
            later.unpersist()

    def _refused(self, rows: DataFrame) -> DataFrame:
        """Mutations that their tables can't take, and why."""
        found = None
        for name, table in self.catalog.tables.items():
            one = mapping.refused(rows.where(F.col("tbl") == name), table, self.configs.get(name, TableConfig()))
            found = one if found is None else found.unionByName(one)
        return found

    def pull(self, folder: str, part: str, limit: int | None = None, as_of: Column | None = None) -> bool:
        """Takes the next files of an object store's folder, at most so many, through their last marker, and remembers it; False if no marker has come."""
        at = self.position(folder)
        files = objects.listing(self.spark, folder, at, limit)
        marker = files.where(F.col("path").rlike(objects.MARKER)).agg(F.max("path").alias("path")).first().path
        if marker is None:
            return False
        clock = self.spark.range(1).select(hlc.resolved_name(F.regexp_extract(F.lit(marker), objects.MARKER, 1)).alias("c")).first().c
        # stable within a batch: it is the file's line that orders what has one clock
        rows = objects.mutations(self.spark, objects.ranges(files)).withColumn("seq", F.monotonically_increasing_id())
        return self.accept(rows, self._meta().get("batch", -1) + 1, as_of, {folder: marker}, {part: (clock.nanos, clock.logical)})

    def start(self, stream: DataFrame, folder: str, trigger: dict | None = None, as_of: Column | None = None) -> StreamingQuery:
        """Accepts a stream of mutations batch by batch; the folder holds the stream's own progress."""
        return stream.writeStream.foreachBatch(lambda batch, number: self.accept(batch, number, as_of)).option("checkpointLocation", folder).trigger(**(trigger or {"availableNow": True})).start()

    def _split(self, rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Rows without those of a table that must wait: behind staged ones of their key, or for a parent."""
        mine, others = rows.where(F.col("tbl") == name), rows.where(F.col("tbl") != name)
        staged, applied = self.store.read("staged").where(F.col("tbl") == name), self.store.read("applied")
        if name not in self.references:
            queued, free = staging.split_by_pending(staged, applied, mine)
            return others.unionByName(free), queued
        column, parent = self.references[name]
        key = self.catalog.tables[parent].keys[0]
        coming = rows.where((F.col("tbl") == parent) & ~F.col("is_delete")).select(F.get_json_object("data", f"$.{key}").alias("id"))
        known = self.table(parent).select(F.col(key).cast("string").alias("id")).union(coming)
        now, later = modes.best_effort_batch(staged, applied, mine.withColumn("__parent", F.get_json_object("data", f"$.{column}")), known, "__parent", "id")
        return others.unionByName(now.drop("__parent")), later.drop("__parent")

    def advance(self, part: str, nanos: int, logical: int = 0) -> None:
        """A partition says that it has sent everything up to a clock."""
        self._guarded(lambda: self.store.commit(tables={"checkpoints": self._advanced({part: (nanos, logical)})}) >= 0)

    def _advanced(self, resolved: dict[str, tuple[int, int]]) -> DataFrame:
        new = self.spark.createDataFrame([(self.group, part, *clock, False) for part, clock in resolved.items()], _schema(CHECKPOINT))
        return checkpoint.advance(self.store.read("checkpoints"), new)

    def ensure(self, parts: list[str]) -> None:
        """Partitions that must be heard of before anything is applied."""
        new = self.spark.createDataFrame([(self.group, p) for p in parts], "grp string, part string")
        self._guarded(lambda: self.store.commit(tables={"checkpoints": checkpoint.ensure(self.store.read("checkpoints"), new)}) >= 0)

    def sweep(self, as_of: Column | None = None) -> bool:
        """Applies what is staged and within bounds; False if there is nothing that can be done."""
        return self._guarded(lambda: self._sweep(as_of))

    def _sweep(self, as_of: Column | None) -> bool:
        bounds = self.bounds()
        if bounds.empty:
            return False
        staged, applied = self.store.read("staged"), self.store.read("applied")
        rows = staging.unapplied(staged.where(hlc.less(hlc.pair(), hlc.literal(*bounds.high))), applied)
        if rows.isEmpty() and self.store.read("checkpoints").where(~F.col("applied") & bounds.contains()).isEmpty():
            return False
        log = checkpoint.commit(self.store.read("checkpoints"), bounds)
        rows = rows.persist()
        try:
            try:
                self._commit(rows, {}, {}, as_of, {"checkpoints": log})
                return True
            except (ValueError, PySparkException):
                free = self._free(rows)
                if free is None:
                    raise
            if free.isEmpty():
                return False
            self._commit(free, {}, {}, as_of)
            return True
        finally:
            rows.unpersist()

    def _free(self, rows: DataFrame) -> DataFrame | None:
        """Rows of transactions that no refused mutation holds up, directly or through others; None if none is refused."""
        batch = F.expr("CAST(CAST(nanos AS DECIMAL(19,0)) * 4294967296BD + logical AS DECIMAL(38,0))")  # transactions in order of their clocks
        key = F.struct("tbl", "key").alias("key")
        bad = self._refused(rows).select(key, batch.alias("since")).persist()
        n = bad.select("key").distinct().count()
        if not n:
            return None
        if n > self.poison_cap:
            raise poison.Full(f"{n} keys")
        batches = rows.select(batch.alias("batch"), key).distinct()
        while True:  # ends, since each round has more keys that wait
            held = poison.spread(batches, bad).withColumnRenamed("batch", "__batch")
            free = rows.withColumn("__batch", batch).join(held, "__batch", "left_anti").drop("__batch")
            alone = self._orphans(free)
            if alone is None or alone.isEmpty():
                return free
            bad = bad.union(alone.select(key, batch.alias("since"))).checkpoint()

    def _orphans(self, rows: DataFrame) -> DataFrame | None:
        """Writes whose parent is neither in its table nor among the rows."""
        found = None
        for name, (column, parent) in self.references.items():
            own = self.catalog.tables[parent].keys[0]
            last = last_by_key(rows.where(F.col("tbl").isin(name, parent))).where("NOT is_delete")
            coming = last.where(F.col("tbl") == parent).select(F.get_json_object("data", f"$.{own}").alias("id"))
            known = self.table(parent).select(F.col(own).cast("string").alias("id")).union(coming)
            children = last.where(F.col("tbl") == name).withColumn("__parent", F.get_json_object("data", f"$.{column}"))
            one = catalog.orphans(children, known, "__parent", "id").select(*staging.ID)
            found = one if found is None else found.unionByName(one)
        return found

    def retire(self, keep_seconds: int = 24 * 3600) -> None:
        """Drops applied rows that are older than the bounds by some time, and checkpoints that say nothing any more."""
        def drop() -> bool:
            through = modes.retirement(self.bounds().low[0], keep_seconds)
            staged, applied = self.store.read("staged"), self.store.read("applied")
            kept = {"staged": staging.retire(staged, applied, through), "applied": applied.where(~hlc.at_most(hlc.pair(), hlc.literal(*through)))}
            return self.store.commit({"checkpoints": checkpoint.compact(self.store.read("checkpoints"))}, compacted=kept) >= 0

        self._guarded(drop)

    def switch(self, lag: float) -> str:
        """The mode that a lag in seconds asks for, taken over."""
        if self.window is not None:
            self.mode = modes.next_mode(self.mode, lag, self.window)
        return self.mode

    # -- applying

    def _commit(self, rows: DataFrame, appended: dict[str, DataFrame], meta: dict, as_of: Column | None, tables: dict[str, DataFrame] | None = None) -> None:
        states, letters, touched = dict(tables or {}), None, {}
        for level in self.levels:
            for name in level:
                made = self._applied(rows.where(F.col("tbl") == name), self.catalog.tables[name], self.configs.get(name, TableConfig()), as_of)
                if made is None:
                    continue
                states[name], dead, numbers = made
                touched[name] = (self._bucket(self.catalog.tables[name]), numbers)
                if dead is not None:
                    letters = dead if letters is None else letters.unionByName(dead)
        logs = appended | {"applied": rows.select(*staging.ID).distinct()} | ({"dead_letters": letters} if letters is not None else {})
        self.store.commit(states, logs, meta=meta | {"buckets": self.buckets}, touched=touched)

    def _bucket(self, table: Table) -> Column:
        return F.pmod(F.xxhash64(*table.keys), F.lit(self.buckets)).cast("int")

    def _applied(self, rows: DataFrame, table: Table, config: TableConfig, as_of: Column | None) -> tuple[DataFrame, DataFrame | None, list[int]] | None:
        """The new state of the buckets that a table's rows are in, dead letters if it has a queue for them, and those buckets; None if there are no rows."""
        last = last_by_key(rows)
        carried = ["tbl", "key", "nanos", "logical", "before", "data"]
        writes = mapping.map_columns(last.where("NOT is_delete").withColumn("__data", F.col("data")), table, config, "__data")
        deletes = mapping.delete_keys(last.where("is_delete"), table, config)
        length = F.when(F.coalesce("arity", F.lit(False)), None).otherwise("a delete's key has another length")
        bucket = self._bucket(table).alias("bucket")
        seen = writes.select(mapping.violation().alias("violation"), bucket).unionByName(deletes.select(length.alias("violation"), bucket))
        found = seen.agg(F.min("violation").alias("violation"), F.array_sort(F.collect_set("bucket")).alias("buckets")).first()  # no more numbers than buckets
        if found.violation is not None:
            raise ValueError(f"{table.name}: {found.violation}")
        if not found.buckets:
            return None
        state = sink.delete(self.store.read(table.name, found.buckets), deletes, table.keys)
        typed = mapping.valid(writes)
        values = [c.name for c in table.columns if c.name in typed.columns]
        rest = [c for c in values if c not in table.keys]
        if not (config.cas or config.deadlines):
            return sink.upsert(state, typed.select(*values), table.keys), None, found.buckets
        made = resolve.decide(state, typed.select(*carried, *values), table.keys, list(config.cas), config.deadlines, as_of)
        state = sink.upsert(state, made.applied.select(*values), table.keys)
        if not config.merge:
            return state, None, found.buckets
        before = mapping.map_columns(made.conflicts.select("key", F.coalesce("before", F.lit("{}")).alias("__before")), table, TableConfig(rename=config.rename, ignore=config.ignore, extras=config.extras), "__before")
        sides = made.conflicts.join(before.select("key", *(F.col(c).alias(f"before_{c}") for c in rest)), "key").withColumn("has_before", F.col("before").isNotNull())
        fallback = config.merge if callable(config.merge) else "dlq" if config.dlq else None
        routed = resolve.route(resolve.merge_rows(sides, rest), rest, fallback)
        state = sink.upsert(state, resolve.fixups(routed, table.keys, rest), table.keys)
        return state, resolve.dead_letters(routed, config.dlq, F.col("data"), F.col("before")) if config.dlq else None, found.buckets
