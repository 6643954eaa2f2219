"""A stream of files into a snapshot table: consistent results under replays and failures."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.dedup import last_by_key
from tidelog.sources import envelope, workload
from tidelog.streaming import modes
from tidelog.streaming.table import SnapshotTable, write_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("val", T.LongType())])


def land(folder, name, rows):
    text = "\n".join(json.dumps({"after": {"id": i, "val": v} if v is not None else None, "key": [i], "updated": f"{n}.0000000000"}) for i, v, n in rows)
    (folder / name).write_text(text + "\n")


def step(target, batch):
    rows = envelope.bulk_lines(batch, F.lit("t")).withColumn("seq", F.col("nanos"))
    typed = rows.select("tbl", "key", "nanos", "logical", "seq", "is_delete", F.get_json_object("key", "$[0]").cast("long").alias("id"), F.get_json_object("data", "$.val").cast("long").alias("val"))
    state, _ = modes.apply_batch(target, typed, ["id"])
    return state, {"applied": typed.select("tbl", "key", "nanos", "logical")}


@pytest.mark.parametrize("chaos", [False, True])
def test_files_reach_the_table_once(spark, tmp_path, chaos):
    landing, table = tmp_path / "in", SnapshotTable(spark, str(tmp_path / "table"), SCHEMA)
    landing.mkdir()
    rng, expected, clock = random.Random(7), {}, 0
    failures = iter([True, False] * 10)

    def shaky(target, batch):
        out = step(target, batch)
        if chaos and next(failures):
            raise OSError("lost")
        return out

    for n in range(3):
        rows = []
        for _ in range(40):
            clock += 1
            i, v = rng.randrange(15), rng.choice([None, clock])
            rows.append((i, v, clock))
            expected[i] = v
        land(landing, f"{n}.ndjson", rows + rows[:5])  # repeats
        for attempt in range(3):
            stream = spark.readStream.format("text").load(str(landing))
            query = write_stream(stream, table, str(tmp_path / "checkpoint"), shaky)
            try:
                query.awaitTermination()
                break
            except Exception:
                assert chaos and attempt < 2
        found = {r.id: r.val for r in table.read().collect()}
        assert found == {i: v for i, v in expected.items() if v is not None}
    assert table.last()["batch"] == 2
    assert table.log("applied", "tbl string, key string, nanos long, logical int").count() == 3 * 45


def test_committed_batches_arent_written_again(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    assert table.read().count() == 0
    assert table.write(0, spark.createDataFrame([(1, 1)], SCHEMA))
    assert not table.write(0, spark.createDataFrame([(2, 2)], SCHEMA))
    assert [tuple(r) for r in table.read().collect()] == [(1, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_cut_give_the_same_state(spark, seed):
    """A workload applied in pieces, some of them replayed, ends as the workload applied at once."""
    log = workload.steps(spark, 500).where("tbl = 'child'").withColumn("is_delete", F.lit(False)).cache()
    whole = last_by_key(log).select("id", "parent", "val")
    rng, at = random.Random(seed), 0
    target = spark.createDataFrame([], whole.schema)
    while at < 500:
        end = at + rng.randrange(60, 200)
        piece = log.where(f"seq >= {max(0, at - rng.randrange(20))} AND seq < {end}")
        state, _ = modes.apply_batch(target, piece, ["id"])
        target = spark.createDataFrame(state.collect(), whole.schema)
        at = end
    assert workload.check(target.where("false"), target, target.where("false"), whole).where("what LIKE 'child %' AND what <> 'child orphan'").count() == 0


def test_best_effort_orphans_wait(spark):
    schema = "tbl string, key string, nanos long, logical int, id long, parent long"
    child = spark.createDataFrame([("child", "[1]", 1, 0, 1, 7), ("child", "[2]", 1, 0, 2, 8)], schema)
    parents = spark.createDataFrame([(8,)], "id long")
    empty = child.where("false")
    now, later = modes.best_effort_batch(empty, empty.select("tbl", "key", "nanos", "logical"), child, parents)
    assert [r.id for r in now.collect()] == [2] and [r.id for r in later.collect()] == [1]
    again = spark.createDataFrame([("child", "[1]", 2, 0, 1, 8)], schema)
    now, later = modes.best_effort_batch(later, empty.select("tbl", "key", "nanos", "logical"), again, parents)
    assert now.count() == 0 and later.count() == 1
