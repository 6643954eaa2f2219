import random
import threading

import pytest
from pyspark.sql import types as T

import tidelog.__main__ as cli
from tidelog.sources import objects
from tidelog.streaming import control
from tidelog.streaming.table import SnapshotTable

SCHEMA = T.StructType([T.StructField("id", T.LongType())])


def test_one_holds_a_lease(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    a, b = control.Lease(table, "x", 10), control.Lease(table, "x", 10)
    assert a.try_take(100) and not b.try_take(105) and a.try_take(108)
    assert not b.try_take(112) and b.try_take(119) and not a.try_take(120)
    assert control.Lease(table, "y").try_take(100)


def test_memo(spark, tmp_path):
    memo = control.Memo.at(spark, str(tmp_path / "m"))
    assert memo.get("k") is None
    memo.put("k", b"one")
    memo.put("other", b"\x00")
    memo.put("k", b"two")
    assert (memo.get("k"), memo.get("other")) == (b"two", b"\x00")
    assert control.describe(memo.table)["commits"] == 3


class Answer(Exception):
    def __init__(self, status):
        self.status = status


@pytest.mark.parametrize("answers, calls, fails", [([429, 500, None], 3, False), ([404], 1, True), ([500] * 20, 10, True)])
def test_retries(answers, calls, fails):
    made = []

    def call():
        status = answers[len(made)]
        made.append(status)
        if status:
            raise Answer(status)
        return "ok"

    if fails:
        with pytest.raises(Answer):
            control.retry(call, control.transient, sleep=lambda s: None)
    else:
        assert control.retry(call, control.transient, sleep=lambda s: None) == "ok"
    assert len(made) == calls


def test_batches_count_themselves(spark):
    batch = spark.createDataFrame([(1, 0, False), (5, 1, True), (3, 0, False)], "nanos long, logical int, is_delete boolean")
    df, seen = control.observed(batch, "batch")
    df.collect()
    assert seen.get == {"n_rows": 3, "n_deletes": 1, "first_nanos": 1, "last_nanos": 5}


def test_objects_become_mutations(spark, tmp_path):
    for n in range(4):
        digits = f"20240101000000{n:09d}0000000000"
        if n == 2:
            (tmp_path / f"{digits}.RESOLVED").write_text("")
        else:
            (tmp_path / f"{digits}-0a-1-2-00000000-items-1.ndjson").write_text('{"after":{"p":%d},"key":[%d],"updated":"%d.0000000000"}\n' % (n, n, n))
    listed = objects.listing(spark, str(tmp_path))
    assert listed.count() == 4 and objects.listing(spark, str(tmp_path), limit=2).count() == 2
    out = objects.mutations(spark, objects.ranges(listed)).collect()
    assert sorted((r.tbl, r.key, r.nanos) for r in out) == [("items", "[0]", 0), ("items", "[1]", 1)]


def test_command_line(spark, small, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "dedup_by_key" in capsys.readouterr().out
    assert cli.main(["sql", "apply_delete"]) == 0 and "SELECT" in capsys.readouterr().out
    assert cli.main(["run", "memo_latest", small]) == 0 and "event_id" in capsys.readouterr().out
    assert cli.main(["workload", "20", str(tmp_path / "w")]) == 0 and spark.read.parquet(str(tmp_path / "w")).count() == 20


def test_a_lease_is_let_go(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA)
    a, b, other = control.Lease(table, "x", 10), control.Lease(table, "x", 10), control.Lease(table, "x-1", 10)
    assert a.try_take(100) and other.try_take(100) and not b.try_take(101)
    b.release()
    assert not b.try_take(102)
    a.release()
    assert b.try_take(103) and not a.try_take(104)
    for at in range(110, 200, 8):
        assert b.try_take(at)
    assert len(table.folder.names("lease-x-")) <= 4  # two of each at most


def test_calls_with_a_common_key_keep_their_order():
    locks, seen, gate = control.Lockset(4), [], threading.Event()

    def call(name, block=False, fail=False):
        def run():
            if block:
                gate.wait(5)
            if fail:
                raise ValueError(name)
            seen.append(name)
            return name

        return run

    first = locks.schedule(["a", "b"], call("first", block=True))
    failing = locks.schedule(["b", "c"], call("failing", fail=True))
    last = locks.schedule(["c", "a", "c"], call("last"))
    free = locks.schedule(["d"], call("free"))
    none = locks.schedule([], call("none"))
    assert free.result(5) == "free" and none.result(5) == "none" and not last.done() and not failing.done()
    gate.set()
    assert first.result(5) == "first" and last.result(5) == "last" and seen[2:] == ["first", "last"]
    with pytest.raises(ValueError, match="failing"):
        failing.result(5)
    locks.close()
    assert not locks.queues


def test_many_calls_on_few_keys():
    locks, rng, seen = control.Lockset(4), random.Random(5), {k: [] for k in range(6)}
    wanted = {k: [] for k in seen}
    futures = []
    for n in range(300):
        keys = rng.sample(range(6), rng.randrange(1, 4))
        for k in keys:
            wanted[k].append(n)
        futures.append(locks.schedule(keys, lambda n=n, keys=keys: [seen[k].append(n) for k in keys]))
    locks.close(futures)
    assert seen == wanted
