"""Conformance: a workload of parents and children through every mode, with replays and failures, ends in the same tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators.dedup import last_by_key
from tidelog.operators.poison import Full
from tidelog.operators.target import difference
from tidelog.plans.catalog import Catalog, Table, orphans
from tidelog.plans.config import TableConfig
from tidelog.sources import envelope, workload
from tidelog.streaming.control import Busy
from tidelog.streaming.engine import Engine

TABLES = {"parent": Table.of("parent", "id long, val long", ("id",)), "child": Table.of("child", "id long, parent long, val long", ("id",))}
N = 50


def log(spark):
    s = workload.steps(spark, N)
    data = F.when(F.col("tbl") == "parent", F.to_json(F.struct("id", "val"))).otherwise(F.to_json(F.struct("id", "parent", "val")))
    return s.select("tbl", "key", data.alias("data"), F.lit(None).cast("string").alias("before"), "nanos", "logical", "seq", F.lit(False).alias("is_delete")).cache()


def engine(spark, path, mode, **more):
    return Engine(spark, str(path), Catalog(dict(TABLES), [("child", "parent")]), references={"child": ("parent", "parent")}, mode=mode, **more)


def fail_at(engine, calls):
    """The folder's commits of these numbers are lost once."""
    real, made = engine.store.folder.create, []

    def create(name, text):
        made.append(name)
        if len(made) in calls:
            raise OSError("lost")
        real(name, text)

    engine.store.folder.create = create


@pytest.mark.parametrize("mode, chaos", [("immediate", True), ("consistent", True), ("best_effort", True), ("consistent", False)])
def test_every_mode_ends_in_the_same_tables(spark, tmp_path, mode, chaos):
    rng, e, whole = random.Random(3), engine(spark, tmp_path, mode), log(spark)
    if chaos:
        fail_at(e, {2, 5})
    at, number = 0, 0
    while at < N:
        end = at + rng.randrange(15, 30)
        piece = whole.where(f"seq >= {max(0, at - 5)} AND seq < {end}")  # some of it comes again
        for _ in range(3):
            try:
                assert e.accept(piece, number)
                break
            except OSError:
                assert chaos
        assert not e.accept(piece, number)
        if mode != "immediate":
            while True:
                try:
                    e.advance("p0", min(end, N) + 1)
                    e.sweep()
                    break
                except OSError:
                    assert chaos
        at, number = end, number + 1
    last = last_by_key(whole)
    for name, table in TABLES.items():
        columns = [c.name for c in table.columns]
        expected = last.where(F.col("tbl") == name).select(*(F.get_json_object("data", f"$.{c}").cast("long").alias(c) for c in columns))
        assert difference(expected, e.table(name), ["id"]).count() == 0
    assert orphans(e.table("child"), e.table("parent"), "parent", "id").count() == 0


def mutations(spark, *rows):
    return spark.createDataFrame([(t, k, d, None, n, 0, n, d is None) for t, k, d, n in rows], "tbl string, key string, data string, before string, nanos long, logical int, seq long, is_delete boolean")


def test_consistent_mode_waits_for_the_slowest_partition(spark, tmp_path):
    e = engine(spark, tmp_path, "consistent")
    e.ensure(["a", "b"])
    e.accept(mutations(spark, ("child", "[1]", '{"id":1,"parent":1,"val":1}', 10), ("parent", "[1]", '{"id":1,"val":1}', 20)), 0)
    e.advance("a", 100)
    e.sweep()
    assert e.table("child").count() == 0
    e.advance("b", 15)
    assert e.sweep() and e.table("child").count() == 1 and e.table("parent").count() == 0
    e.advance("b", 100)
    assert e.sweep() and e.table("parent").count() == 1 and not e.sweep()
    e.retire(keep_seconds=0)
    assert e.store.read("staged").count() == 0


def test_orphans_wait_in_best_effort_mode(spark, tmp_path):
    e = engine(spark, tmp_path, "best_effort")
    e.accept(mutations(spark, ("child", "[1]", '{"id":1,"parent":7,"val":1}', 1)), 0)
    assert e.table("child").count() == 0 and e.store.read("staged").count() == 1
    e.accept(mutations(spark, ("parent", "[7]", '{"id":7,"val":1}', 2), ("child", "[2]", '{"id":2,"parent":7,"val":1}', 3), ("child", "[1]", '{"id":1,"parent":7,"val":2}', 4)), 1)
    assert [r.id for r in e.table("child").collect()] == [2] and e.store.read("staged").count() == 2
    e.advance("p", 10)
    e.sweep()
    assert sorted((r.id, r.val) for r in e.table("child").collect()) == [(1, 2), (2, 1)]


def test_a_stream_of_files_feeds_the_engine(spark, tmp_path):
    landing, e = tmp_path / "in", engine(spark, tmp_path / "out", "consistent")
    landing.mkdir()
    for n, ids in enumerate(([1, 2], [2, 3])):
        (landing / f"{n}.ndjson").write_text("".join('{"after":{"id":%d,"val":%d},"key":[%d],"updated":"%d.0000000000"}\n' % (i, 10 * n + i, i, n + 1) for i in ids))
        lines = spark.readStream.format("text").load(str(landing))
        rows = envelope.bulk_lines(lines, F.lit("parent")).withColumn("seq", F.col("nanos"))
        e.start(rows, str(tmp_path / "progress")).awaitTermination()
    e.advance("p", 5)
    assert e.sweep() and sorted((r.id, r.val) for r in e.table("parent").collect()) == [(1, 1), (2, 12), (3, 13)]


def test_violations_change_nothing(spark, tmp_path):
    e = engine(spark, tmp_path, "immediate")
    with pytest.raises(ValueError, match="unexpected columns: x"):
        e.accept(mutations(spark, ("parent", "[1]", '{"id":1,"x":1}', 1)), 0)
    with pytest.raises(ValueError, match="missing keys: id"):
        e.accept(mutations(spark, ("parent", "[1]", '{"val":1}', 1)), 0)
    with pytest.raises(ValueError, match="another length"):
        e.accept(mutations(spark, ("parent", "[1,2]", None, 1)), 0)
    assert e.store.last()["step"] == -1


@pytest.mark.parametrize("merge, dlq, expected, letters", [(None, None, 5, 0), ("standard", "lost", 5, 1)])
def test_conflicts(spark, tmp_path, merge, dlq, expected, letters):
    tables = {"t": Table.of("t", "k long, ver long, v long", ("k",))}
    e = Engine(spark, str(tmp_path), Catalog(tables), {"t": TableConfig(cas=("ver",), merge=merge, dlq=dlq)}, mode="immediate")
    e.accept(mutations(spark, ("t", "[1]", '{"k":1,"ver":5,"v":5}', 1)), 0)
    stale = mutations(spark, ("t", "[1]", '{"k":1,"ver":3,"v":3}', 2)).withColumn("before", F.lit('{"k":1,"ver":2,"v":2}'))
    e.accept(stale, 1)
    assert e.table("t").first().v == expected and e.store.read("dead_letters").count() == letters


def test_lag_switches_modes(spark, tmp_path):
    e = engine(spark, tmp_path, "consistent", window=100)
    assert [e.switch(lag) for lag in (50, 100, 50, 25)] == ["consistent", "best_effort", "best_effort", "consistent"]


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    e = engine(spark, tmp_path, "immediate")
    e.accept(mutations(spark, *(("parent", f"[{i}]", f'{{"id":{i},"val":1}}', 1) for i in range(200))), 0)
    before = e.store.last()["tables"]
    assert set(before) == {"parent"} and len(before["parent"]) == e.buckets
    e.accept(mutations(spark, ("parent", "[7]", '{"id":7,"val":2}', 2), ("parent", "[8]", None, 2)), 1)
    after = e.store.last()["tables"]
    changed = [b for b in before["parent"] if after["parent"].get(b) != before["parent"][b]]
    assert set(after) == {"parent"} and 1 <= len(changed) <= 2
    rows = {r.id: r.val for r in e.table("parent").collect()}
    assert len(rows) == 199 and rows[7] == 2 and 8 not in rows and rows[9] == 1


def test_a_bucket_that_is_emptied_goes(spark, tmp_path):
    e = engine(spark, tmp_path, "immediate")
    e.accept(mutations(spark, ("parent", "[7]", '{"id":7,"val":2}', 1)), 0)
    e.accept(mutations(spark, ("parent", "[7]", None, 2)), 1)
    assert e.table("parent").count() == 0 and e.store.last()["tables"]["parent"] == {}
    e.accept(mutations(spark, ("parent", "[7]", '{"id":7,"val":3}', 3)), 2)
    assert [tuple(r) for r in e.table("parent").collect()] == [(7, 3)]


def test_another_format_is_an_error(spark, tmp_path):
    e = engine(spark, tmp_path, "immediate")
    e.accept(mutations(spark, ("parent", "[7]", '{"id":7,"val":2}', 1)), 0)
    commit = next(tmp_path.glob("commit-*"))
    text = commit.read_text()
    commit.unlink()
    for crc in tmp_path.glob(".commit-*.crc"):
        crc.unlink()
    commit.write_text(text.replace('"format": 2', '"format": 1'))
    with pytest.raises(ValueError, match="format 1"):
        e.table("parent")


def test_best_effort_stages_what_its_table_refuses(spark, tmp_path):
    """One that can't be written and later ones of its key wait; others, and earlier ones of the key, are applied."""
    e = engine(spark, tmp_path, "best_effort")
    e.accept(
        mutations(
            spark,
            ("parent", "[1]", '{"id":1,"val":1}', 1),
            ("parent", "[1]", '{"id":1,"val":"much"}', 2),
            ("parent", "[1]", '{"id":1,"val":3}', 3),
            ("parent", "[2]", '{"id":2,"val":2,"more":0}', 4),
            ("parent", "[3]", '{"id":3,"val":3}', 5),
            ("parent", "[4,5]", None, 6),
            ("child", "[9]", '{"id":9,"parent":2,"val":1}', 7),
        ),
        0,
    )
    assert sorted((r.id, r.val) for r in e.table("parent").collect()) == [(1, 1), (3, 3)] and e.table("child").count() == 0
    assert sorted(r.nanos for r in e.store.read("staged").collect()) == [2, 3, 4, 6, 7]
    assert e.metrics()["parent"] == {"mutations": 6, "deletes": 1, "waited": 4, "last_nanos": 6} and e.metrics()["child"]["waited"] == 1


def test_a_sweep_goes_on_around_refused_transactions(spark, tmp_path):
    """Transactions wait that share a key with one that waits, or refer to a row of one; the window stays until none does."""
    e = engine(spark, tmp_path, "consistent")
    e.accept(
        mutations(
            spark,
            ("parent", "[1]", '{"id":1,"val":"bad"}', 10),
            ("parent", "[2]", '{"id":2,"val":2}', 10),
            ("parent", "[2]", '{"id":2,"val":3}', 20),
            ("parent", "[3]", '{"id":3,"val":3}', 20),
            ("parent", "[3]", '{"id":3,"val":4}', 30),
            ("parent", "[4]", '{"id":4,"val":4}', 30),
            ("parent", "[5]", '{"id":5,"val":5}', 40),
            ("child", "[6]", '{"id":6,"parent":4,"val":6}', 50),
            ("child", "[7]", '{"id":7,"parent":5,"val":7}', 60),
        ),
        0,
    )
    e.advance("p", 100)
    low = e.bounds().low
    assert e.sweep()
    assert [r.id for r in e.table("parent").collect()] == [5] and [r.id for r in e.table("child").collect()] == [7]
    assert e.bounds().low == low and not e.sweep()
    repaired = Engine(spark, str(tmp_path), Catalog({**TABLES, "parent": Table.of("parent", "id long, val string", ("id",))}, [("child", "parent")]), references=e.references)
    assert repaired._free(repaired.store.read("staged")) is None  # a column that holds texts refuses nothing


def test_a_sweep_stops_at_too_many_refusals(spark, tmp_path):
    e = engine(spark, tmp_path, "consistent", poison_cap=1)
    e.accept(mutations(spark, ("parent", "[1]", "{}", 10), ("parent", "[2]", "{}", 20)), 0)
    e.advance("p", 100)
    with pytest.raises(Full):
        e.sweep()


def test_unknown_tables_are_an_error(spark, tmp_path):
    e = engine(spark, tmp_path, "consistent")
    with pytest.raises(Exception, match="no table other"):
        e.accept(mutations(spark, ("other", "[1]", '{"id":1}', 1)), 0)
    assert e.store.last()["step"] == -1


def test_lost_commits_are_made_again(spark, tmp_path):
    e = engine(spark, tmp_path, "immediate")
    fail_at(e, {1, 2})
    assert e.accept(mutations(spark, ("parent", "[1]", '{"id":1,"val":1}', 1)), 0) and e.table("parent").count() == 1
    e = engine(spark, tmp_path, "immediate", attempts=1)
    fail_at(e, {1})
    with pytest.raises(OSError):
        e.accept(mutations(spark, ("parent", "[2]", '{"id":2,"val":1}', 2)), 1)
    assert e.table("parent").count() == 1


def test_one_engine_at_a_time(spark, tmp_path):
    row = mutations(spark, ("parent", "[1]", '{"id":1,"val":1}', 1))
    first, second = (engine(spark, tmp_path, "immediate", lease_seconds=60) for _ in range(2))
    assert first.accept(row, 0)
    with pytest.raises(Busy):
        second.accept(row, 1)
    first.lease.release()
    assert second.accept(row, 1) and not second.accept(row, 0)


def test_buckets_stay_as_they_are(spark, tmp_path):
    engine(spark, tmp_path, "immediate").accept(mutations(spark, ("parent", "[1]", '{"id":1,"val":1}', 1)), 0)
    with pytest.raises(ValueError, match="16 buckets"):
        engine(spark, tmp_path, "immediate", buckets=8)


def test_files_of_an_object_store_are_pulled_once(spark, tmp_path):
    landing, e = tmp_path / "in" / "2024-01-01", engine(spark, tmp_path / "out", "consistent")
    landing.mkdir(parents=True)
    folder = str(landing.parent)
    stamp = lambda s: f"20240101000000{s:09d}0000000000"
    line = '{"after":{"id":%d,"val":%d},"key":[%d],"updated":"%d.0000000000"}\n'
    clock = 1704067200 * 10**9
    (landing / f"{stamp(1)}-a-1-2-00000000-parent-1.ndjson").write_text(line % (1, 1, 1, clock + 1))
    assert not e.pull(folder, "p")
    (landing / f"{stamp(5)}.RESOLVED").write_text("")
    (landing / f"{stamp(7)}-a-1-2-00000000-parent-1.ndjson").write_text(line % (2, 2, 2, clock + 7))
    assert e.pull(folder, "p") and not e.pull(folder, "p")
    assert e.position(folder).endswith(".RESOLVED") and e.sweep() and [r.id for r in e.table("parent").collect()] == [1]
    (landing / f"{stamp(9)}.RESOLVED").write_text("")
    assert e.pull(folder, "p") and e.sweep() and sorted(r.id for r in e.table("parent").collect()) == [1, 2]
    e.retire(keep_seconds=0)
    assert e.store.read("checkpoints").count() == 1 and e.bounds().low == (clock + 9, 0)
