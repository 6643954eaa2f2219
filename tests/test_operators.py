"""Operators on small tables: clashes, ties, nulls, empties, errors."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions import hlc, values
from tidelog.operators import checkpoint, dedup, hooks, mapping, poison, resolve, staging
from tidelog.operators import target as sink
from tidelog.plans.catalog import Catalog, Table, depths
from tidelog.plans.config import SourceConfig, TableConfig
from tidelog.sources import envelope, logical, objects
from tidelog.streaming import modes

MUTATION = "tbl string, key string, nanos long, logical int, seq long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- dedup


def test_last_by_key(spark):
    df = spark.createDataFrame([("t", "[1]", 100, 100, 0, "a"), ("t", "[2]", 1, 0, 1, "b"), ("t", "[1]", 0, 0, 2, "c"), ("t", "[3]", 5, 0, 3, "d"), ("t", "[3]", 5, 0, 4, "e")], MUTATION)
    assert [r[5] for r in rows(dedup.last_by_key(df))] == ["a", "b", "e"]
    assert len(rows(dedup.last_by_time_key(df))) == 4
    assert rows(dedup.last_by_key(df.where("false"))) == []


def test_null_key_is_an_error(spark):
    df = spark.createDataFrame([("t", None, 1, 0, 0, "a")], MUTATION)
    with pytest.raises(Exception, match="key is null"):
        dedup.last_by_key(df).collect()


# ---------------------------------------------------------------- compare-and-set and deadlines


def state_after(spark, cas, deadlines):
    """One key through six batches: (ver, minutes from now)."""
    target = spark.createDataFrame([], "pk int, ver int, at timestamp")
    seen = []
    for ver, minutes in ((0, 60), (100, 60), (5, 60), (200, -60), (9, -60), (300, 60)):
        row = spark.sql(f"SELECT 1 AS pk, {ver} AS ver, timestamp_seconds(1000000 + {60 * minutes}) AS at")
        target = spark.createDataFrame(resolve.conditional_upsert(target, row, ["pk"], cas, deadlines, F.expr("timestamp_seconds(1000000)")).collect(), target.schema)
        found = target.collect()
        assert len(found) == 1
        if not seen or seen[-1] != found[0].ver:
            seen.append(found[0].ver)
    return seen


@pytest.mark.parametrize("cas, deadlines, expected", [((), {}, [0, 100, 5, 200, 9, 300]), (("ver",), {}, [0, 100, 200, 300]), ((), {"at": "10 minutes"}, [0, 100, 5, 300]), (("ver",), {"at": "10 minutes"}, [0, 100, 300])])
def test_conditions(spark, cas, deadlines, expected):
    assert state_after(spark, list(cas), deadlines) == expected


def test_dropped_by_deadline_is_a_conflict(spark):
    target = spark.sql("SELECT 1 AS pk, 1 AS ver, timestamp_seconds(0) AS at")
    late = spark.sql("SELECT 1 AS pk, 2 AS ver, timestamp_seconds(0) AS at UNION ALL SELECT 2, 2, timestamp_seconds(0)")
    made = resolve.decide(target, late, ["pk"], ["ver"], {"at": "10 minutes"}, F.expr("timestamp_seconds(1000000)"))
    assert rows(made.applied) == [] and [r.pk for r in made.conflicts.collect()] == [1]


def test_apply_once_is_what_its_parts_are(spark):
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 5, "c")], "pk int, ver int, s string")
    batch = spark.createDataFrame([(1, 6, "x", False), (2, 4, "y", False), (3, 9, "z", True), (4, 1, "n", False), (5, 1, "d", True)], "pk int, ver int, s string, gone boolean")
    made = resolve.apply_once(target, batch, ["pk"], ["ver"], is_delete="gone")
    assert rows(made.applied) == [(1, 6, "x"), (2, 5, "b"), (4, 1, "n")]
    assert rows(made.conflicts.select("pk", "ver", "target_ver")) == [(2, 4, 5)]


# ---------------------------------------------------------------- three-way merge


@pytest.mark.parametrize(
    "before, proposed, target, merged, stuck",
    [
        ((0, 1), (0, 42), (1000, 1), (1000, 42), []),
        ((0, 1), (0, None), (0, 1), (0, None), []),
        ((99, 1), (0, 1), (1000, 1), (1000, 1), ["a"]),
        ((None, None), (1, 2), (1, 2), (1, 2), []),
        ((5, 5), (6, 6), (6, 6), (6, 6), []),
    ],
)
def test_merge(spark, before, proposed, target, merged, stuck):
    df = spark.createDataFrame([(*before, *proposed, *target, True)], "before_a int, before_b int, a int, b int, target_a int, target_b int, has_before boolean")
    row = resolve.merge_rows(df, ["a", "b"]).first()
    assert (row.merged_a, row.merged_b, row.unmerged) == (*merged, stuck)


def test_two_way_merge(spark):
    df = spark.createDataFrame([(None, 1, 2, False), (None, 2, 2, False)], "before_a int, a int, target_a int, has_before boolean")
    assert [r.unmerged for r in resolve.merge_rows(df, ["a"]).collect()] == [["a"], []]


def test_unmerged_without_fallback_is_an_error(spark):
    df = spark.createDataFrame([(0, 1, 2, True)], "before_a int, a int, target_a int, has_before boolean")
    with pytest.raises(Exception, match="unmerged columns: a"):
        resolve.route(resolve.merge_rows(df, ["a"]), ["a"]).collect()


# ---------------------------------------------------------------- mapping


def test_big_numbers_survive(spark):
    table = Table.of("t", "k long, d decimal(38,23)", ("k",))
    df = spark.createDataFrame([('{"k": 9007199254740995, "d": 0.12345678901234567890123}',)], "data string")
    row = mapping.valid(mapping.map_columns(df, table)).first()
    assert row.k == 2**53 + 3 and str(row.d) == "0.12345678901234567890123"


def test_settings_are_checked():
    table = Table.of("t", "k long, v string", ("k",))
    for bad in (TableConfig(cas=("x",)), TableConfig(extras="x"), TableConfig(merge="standard"), TableConfig(ignore=("k",)), TableConfig(rename={"x": "y"})):
        with pytest.raises(ValueError):
            bad.check(table)
    TableConfig(cas=("V",)).check(table)


def test_table_without_key_gets_one():
    assert Table.of("t", "v string", ()).keys == ["rowid"]


@pytest.mark.parametrize("text, plain", [("4E-2", "0.04"), ("4.321E10", "43210000000"), ("1.50", "1.5"), ("100", "100"), ("x", None)])
def test_exponents(spark, text, plain):
    assert spark.range(1).select(values.plain_decimal(F.lit(text)).alias("x")).first().x == plain


@pytest.mark.parametrize("path, table", [("2024/202401-0877fe-1-2-00000000-mytable-2.ndjson", "mytable"), ("202401-0877fe-1-2-00000000-mytable-2.json", None), ("-mytable-2.ndjson", None), ("", None), ("202401-0877fe-1-2-00000000-my-table-2.ndjson", "my-table")])
def test_table_of_path(spark, path, table):
    assert spark.range(1).select(values.table_of_path(F.lit(path)).alias("x")).first().x == table


# ---------------------------------------------------------------- staging and checkpoints


def staged(spark, *ids):
    return spark.createDataFrame([("t", f"[{k}]", n, 0, i, "v") for i, (k, n) in enumerate(ids)], MUTATION)


def test_stage_twice_mark_retire(spark):
    mine = staged(spark, *((k, 1) for k in range(100)))
    empty = mine.where("false")
    first = staging.fresh(empty, mine)
    assert first.count() == 100 and staging.fresh(first, mine).count() == 0
    applied = staging.mark(empty.select(*staging.ID), first)
    assert staging.unapplied(first, applied).count() == 0
    assert staging.retire(first, applied, (1, 0)).count() == 0
    assert staging.mark(applied, first).count() == 100


def test_keys_queue_behind_staged_ones(spark):
    log = staged(spark, (1, 1))
    new = staged(spark, (0, 2), (1, 2), (2, 2))
    queued, free = staging.split_by_pending(log, log.where("false"), new)
    assert [r.key for r in queued.collect()] == ["[1]"] and sorted(r.key for r in free.collect()) == ["[0]", "[2]"]
    assert staging.split_by_pending(log, log.select(*staging.ID), new)[1].count() == 3


LOG = "grp string, part string, nanos long, logical int, applied boolean"


def window(spark, log):
    r = checkpoint.refresh(log).first()
    return r.low_nanos, r.high_nanos


def test_checkpoint_window(spark):
    log = spark.createDataFrame([("g", "a", n, 0, n <= 5) for n in (2, 5, 10, 15, 20, 25)], LOG)
    assert window(spark, log) == (5, 25)
    log = checkpoint.commit(log, hlc.Range.including((6, 0), (10, 0)))
    assert window(spark, log) == (10, 25)
    log = checkpoint.commit(log, hlc.Range.including((15, 0), (25, 0)))
    assert window(spark, log) == (25, 25)
    gap = spark.createDataFrame([("g", "a", n, 0, n in (100, 110)) for n in (100, 105, 107, 110)], LOG)
    assert window(spark, gap)[0] == 100
    assert window(spark, checkpoint.commit(gap, hlc.Range.including((105, 0), (107, 0)))) == (110, 110)
    slow = spark.createDataFrame([("g", p, 2, 0, False) for p in "abc"] + [("g", "a", 9, 0, False)], LOG)
    assert window(spark, slow) == (0, 2)
    more = checkpoint.ensure(spark.createDataFrame([("g", "a", 110, 0, True)], LOG), spark.createDataFrame([("g", "b")], "grp string, part string"))
    assert window(spark, more) == (1, 1)


def test_checkpoints_dont_go_backwards(spark):
    log = spark.createDataFrame([("g", "a", 10, 0, False)], LOG)
    assert checkpoint.advance(log, log).count() == 1
    assert checkpoint.advance(log, spark.createDataFrame([("g", "a", 11, 0, False), ("g", "b", 1, 0, False)], LOG)).count() == 3
    with pytest.raises(Exception, match="going backwards"):
        checkpoint.advance(log, spark.createDataFrame([("g", "a", 9, 0, False)], LOG)).collect()


def test_common_progress(spark):
    progress = spark.createDataFrame([("x", 1, 1), ("y", 2, 1)], "tbl string, nanos long, logical int")
    tables = lambda *n: spark.createDataFrame([(t,) for t in n], "tbl string")
    assert rows(checkpoint.common_progress(progress, tables("x", "y"))) == [(1, 1)]
    assert rows(checkpoint.common_progress(progress, tables("x", "z"))) == []
    assert rows(checkpoint.common_progress(progress, tables())) == []


# ---------------------------------------------------------------- references


GRAPH = [("child", "parent"), ("child2", "child"), ("three", "child2"), ("three", "parent"), ("self", "self"), ("self_child", "self")]


def test_levels_and_depths_agree(spark):
    names = sorted({n for r in GRAPH for n in r})
    levels = Catalog({n: None for n in names}, GRAPH).levels()
    found = {r.tbl: r.depth for r in depths(spark, spark.createDataFrame([(n,) for n in names], "tbl string"), spark.createDataFrame(GRAPH, "child string, parent string")).collect()}
    assert found == {t: i for i, level in enumerate(levels) for t in level} == {"parent": 0, "self": 0, "child": 1, "self_child": 1, "child2": 2, "three": 3}
    with pytest.raises(ValueError, match="cycle"):
        Catalog({"a": None, "b": None}, [("a", "b"), ("b", "a")]).levels()


# ---------------------------------------------------------------- sources


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_query_lines(spark):
    good = lines(spark, '{"after":{"a":42,"b":"x"},"updated":"1.0"}', '{"after":null,"before":{"a":43,"b":"y"},"updated":"1.0"}', '{"after":null,"before":null,"updated":"1.0"}')
    assert [r.key for r in envelope.query_lines(good, F.lit("t"), ["a", "b"]).orderBy("key").collect()] == ['[42,"x"]', '[43,"y"]']
    with pytest.raises(Exception, match="no key column"):
        envelope.query_lines(lines(spark, '{"after":{"b":1},"updated":"1.0"}'), F.lit("t"), ["a"]).collect()


def test_a_line_needs_a_clock(spark):
    with pytest.raises(Exception, match="no clock"):
        envelope.bulk_lines(lines(spark, '{"after":{"a":1},"key":[1]}'), F.lit("t")).collect()


def test_webhook_length(spark):
    body = '{"payload":[{"after":{"v":9007199254740995},"key":[1],"topic":"a.b.T","updated":"1.0"}],"length":%d}'
    row = envelope.webhook_bodies(lines(spark, body % 1, "", '{"resolved":"1.0"}')).first()
    assert (row.tbl, row.key, row.data) == ("T", "[1]", '{"v":9007199254740995}')
    with pytest.raises(Exception, match="length differs"):
        envelope.webhook_bodies(lines(spark, body % 2)).collect()


@pytest.mark.parametrize("log, low, offset", [("R1 M2 R2 R3 R4 R5", 4, 3), ("R1 R1 M2 R2 R3 R3 R4 R5", 4, 5), ("R1 M2 R2", 0, 0), ("R1 M2 R2", 9, 2)])
def test_seek(spark, log, low, offset):
    text = lambda m: '{"resolved":"%s.0000000000"}' % m[1:] if m[0] == "R" else '{"after":{},"updated":"%s.0"}' % m[1:]
    df = spark.createDataFrame([("t", 0, i, "[1]", text(m)) for i, m in enumerate(log.split())], "topic string, part int, offset long, key string, value string")
    assert [r.offset for r in envelope.seek(df, (low, 0)).collect()] == [offset]


def test_resolved_ranges_skip_open_files(spark):
    digits = lambda n: f"20240101000000{n:09d}0000000000"
    names = [digits(n) + (".RESOLVED" if n in (2, 3, 5) else "-0a-1-2-00000000-t-1.ndjson") for n in range(7)]
    out = objects.ranges(spark.createDataFrame([(n,) for n in names], "path string"))
    found = {int(r.path[14:23]): int(r.marker[14:23]) for r in out.collect()}
    assert found == {0: 2, 1: 2, 4: 5}


def test_resolved_ranges_take_one_step_a_file(spark, capsys):
    rng = random.Random(3)
    names = [f"{d}/{rng.choice([20240101000000, 20240101000001, 20231231])}{rng.randrange(10**6):06d}" for d in ("a", "b/c") for _ in range(300)]
    paths = [f"{n:0<{len(n.rpartition('/')[0]) + 34}}.RESOLVED" if rng.random() < 0.03 else f"{n}-1-2-3-4-tbl-x.ndjson" for n in names] + ["no-folder.ndjson", "é" * 20]
    found = objects.ranges(spark.createDataFrame([(p,) for p in paths], "path string"))
    found.explain()
    assert "unboundedfollowing" not in capsys.readouterr().out.lower()  # such a frame is read again for each row
    after = lambda p: min((q for q in paths if q.endswith(".RESOLVED") and q > p and q.rpartition("/")[0] == p.rpartition("/")[0]), default=None)
    expected = sorted((p, after(p).rpartition("/")[2][:33]) for p in paths if p.endswith("-x.ndjson") and after(p))
    assert len(expected) > 400 and sorted((r.path, r.marker) for r in found.collect()) == expected


def test_truncate_is_an_error(spark):
    events = spark.createDataFrame([(1, 1, "truncate", "t", None, None), (2, 1, "commit", None, None, None)], "lsn long, xid long, kind string, tbl string, key string, data string")
    with pytest.raises(Exception, match="truncate of t"):
        logical.wal_mutations(events).collect()


# ---------------------------------------------------------------- hooks, modes, poison


def test_delete_keys_keep_their_length(spark):
    df = spark.createDataFrame([("t", "[1]")], "tbl string, key string")
    with pytest.raises(Exception, match="another length"):
        hooks.map_keys(df, lambda k: F.lit("[1,2]"), 1).collect()


@pytest.mark.parametrize("current, lag, window, expected", [(None, 5, 10, "best_effort"), ("consistent", 5, 10, "consistent"), ("best_effort", 5, 10, "best_effort"), ("consistent", 10, 10, "best_effort"), ("best_effort", 2.5, 10, "consistent"), ("best_effort", 99, 0, "consistent")])
def test_mode(current, lag, window, expected):
    assert modes.next_mode(current, lag, window) == expected


def test_poison():
    held = poison.PoisonSet(cap=2)
    held.mark([1])
    assert held.touches([1, 2]) and held.touches([2]) and held.full and not held.touches([3])
    with pytest.raises(poison.Full):
        held.mark([4])


def fold(batches, keys):
    held = poison.PoisonSet()
    held.mark(keys)
    of = {}
    for batch, key in batches:
        of.setdefault(batch, set()).add(key)
    return {batch for batch in sorted(of) if held.touches(of[batch])}


def test_contagion_is_the_fold(spark, small):
    chain = [(b, k) for b in range(1, 12) for k in (b, b + 1)] + [(0, 5), (20, 50)]
    orders = spark.read.parquet(f"{small}/orders.parquet").select(F.col("o_custkey").alias("batch"), (F.col("o_orderkey") % 400).alias("key")).distinct()
    for batches, keys in ((spark.createDataFrame(chain, "batch long, key long"), [1]), (orders, [7, 190])):
        held = {r.batch for r in poison.spread(batches, spark.createDataFrame([(k, 0) for k in keys], "key long, since long")).collect()}
        assert held == fold(map(tuple, batches.collect()), keys) and len(held) >= 11


def test_custom_strategy_must_exist(spark):
    with pytest.raises(ValueError):
        sink.apply_custom(spark.range(1), spark.range(1), ["id"], "none")


# ---------------------------------------------------------------- what must not pass silently


@pytest.mark.parametrize("value, error", [("{garbage", "malformed"), ("[1]", "malformed"), (None, "malformed"), ("", "malformed"), ('{"after":{"a":1}}', "no clock"), ('{"after":{"a":1},"updated":"x"}', "no clock"), ('{"resolved":"x"}', "no clock")])
def test_bad_messages_are_errors(spark, value, error):
    df = spark.createDataFrame([("t", 0, 1, "[1]", value)], "topic string, part int, offset long, key string, value string")
    assert [r.error for r in envelope.topic_errors(df).collect()] == [error]
    with pytest.raises(Exception, match=f"{error} at 0/1"):
        envelope.topic_messages(df).collect()


@pytest.mark.parametrize("body, error", [("{garbage", "malformed"), ('{"x":1}', "unknown field"), ('{"payload":[{"after":{},"topic":"t","updated":"1.0","y":1}],"length":1}', "unknown field in a line"), ('{"payload":[{"after":{},"topic":"t"}],"length":1}', "no clock in a line"), ('{"resolved":"abc"}', "no clock")])
def test_bad_bodies_are_errors(spark, body, error):
    assert [r.error for r in envelope.webhook_errors(lines(spark, body, "")).collect()] == [error]
    for read in (envelope.webhook_bodies, lambda df: envelope.query_webhook_bodies(df, {"t": ["a"]}), envelope.webhook_resolved):
        with pytest.raises(Exception, match=error):
            read(lines(spark, body)).collect()


def test_resolved_bodies_and_lines(spark):
    assert [tuple(r) for r in envelope.webhook_resolved(lines(spark, '{"resolved":"7.0000000002"}', '{"payload":[],"length":0}')).collect()] == [(7, 2)]
    with pytest.raises(Exception, match="no clock"):
        envelope.resolved_lines(lines(spark, '{"resolved":"abc"}')).collect()
    with pytest.raises(Exception):
        envelope.bulk_lines(lines(spark, "{garbage"), F.lit("t")).collect()


@pytest.mark.parametrize("value", ['"abc"', "99999999999", "[1]"])
def test_values_that_a_type_cannot_hold_are_errors(spark, value):
    df = spark.createDataFrame([('{"k":1,"v":%s}' % value,)], "data string")
    with pytest.raises(Exception, match="(?i)cast"):
        mapping.map_columns(df, Table.of("t", "k long, v int", ("k",))).collect()


def test_flushes_start_again_at_zero(spark):
    log = [("t", f"[{i}]", n, l) for i, (n, l) in enumerate([(10, 2), (10, 3), (11, 0), (12, 0)])]
    made = staging.flush_groups(spark.createDataFrame(log, "tbl string, key string, nanos long, logical int"), 2)
    assert [r.flush for r in made.orderBy("nanos", "logical").collect()] == [0, 0, 1, 1]
    log = [("t", f"[{i}]", i // 2, 0) for i in range(8)]
    made = staging.flush_groups(spark.createDataFrame(log, "tbl string, key string, nanos long, logical int"), 3)
    assert [r.flush for r in made.orderBy("nanos", "logical").collect()] == [0, 0, 1, 1]
    assert staging.flush_groups(made.selectExpr("'t' AS tbl", "'k' AS key", "nanos", "logical").where("false"), 3).count() == 0


def test_flushes_equal_the_fold(spark):
    rng = random.Random(3)
    sizes = [rng.choice([1, 1, 2, 3, 40]) for _ in range(400)]
    log = spark.createDataFrame([("t", f"[{i}.{k}]", i, i % 4) for i, n in enumerate(sizes) for k in range(n)], "tbl string, key string, nanos long, logical int")
    expected, waiting, number = [], 0, 0
    for n in sizes:
        expected.append(number)
        waiting += n
        if waiting >= 25:
            waiting, number = 0, number + 1
    assert [r.flush for r in staging.flush_groups(log, 25).orderBy("nanos").collect()] == expected


def test_row_hooks_keep_digits_and_keys_are_json(spark):
    hook = hooks.row_hook(lambda doc: doc | {"n": 1})
    df = spark.createDataFrame([('{"d":0.12345678901234567890123,"e":1E+30,"s":"x"}',)], "data string")
    assert df.select(hook(F.col("data"), F.lit(1))).first()[0] == '{"d":0.12345678901234567890123,"e":1E+30,"s":"x","n":1}'
    keyed = hooks.rekey(spark.createDataFrame([('{"id":"a\\"b\\\\c"}',)], "data string"), Table.of("t", "id string", ("id",))).first().key
    assert json.loads(keyed) == ['a"b\\c']


@pytest.mark.parametrize("text, plain", [("1.5E-15", "0.0000000000000015"), ("1E+30", "1" + "0" * 30), ("-0.50e1", "-5"), ("-0", "0"), (".5", "0.5"), ("5.", "5"), ("", None), (".", None), ("1e9999999", None), ("123456789012345678901234567890123456789012.5", "123456789012345678901234567890123456789012.5")])
def test_numbers_are_exact(spark, text, plain):
    assert spark.createDataFrame([(text,)], "x string").select(values.plain_decimal(F.col("x")).alias("x")).first().x == plain


def test_rows_without_a_key_have_the_same_one_again(spark):
    events = spark.createDataFrame([(1, 1, "insert", "t", None, "{}"), (2, 1, "insert", "t", None, "{}"), (3, 1, "commit", None, None, None)], "lsn long, xid long, kind string, tbl string, key string, data string")
    first, second = ([r.key for r in logical.wal_mutations(events).orderBy("seq").collect()] for _ in range(2))
    assert first == second == ['["3-1"]', '["3-2"]']


def test_keys_of_deletes_are_mapped_without_a_map_of_writes(spark):
    df = spark.createDataFrame([("t", "[1]", None, 1, True), ("t", "[2]", '{"k":2}', 2, False)], "tbl string, key string, data string, nanos long, is_delete boolean").withColumn("logical", F.lit(0))
    source = SourceConfig(delete_key={"t": lambda _: F.lit("[9]")})
    out = hooks.pipeline(df, source, Catalog({"t": Table.of("t", "k long", ("k",))}))
    assert sorted(r.key for r in out.collect()) == ["[2]", "[9]"]


def test_refused_mutations(spark):
    table = Table.of("t", "k long, v int, at date", ("k",))
    data = [(1, '{"k":1,"v":1,"at":"2024-01-01"}'), (2, '{"k":2,"v":"x"}'), (3, '{"k":3,"v":99999999999,"at":"no"}'), (4, '{"k":4,"v":null}'), (5, '{"v":1}'), (6, "["), (7, '{"k":7,"z":1}')]
    df = spark.createDataFrame([("t", f"[{k}]", d, k, False) for k, d in data] + [("t", "[8]", None, 8, True), ("t", "[8,9]", None, 9, True), ("t", '["x"]', None, 10, True), ("t", "x", None, 11, True)], "tbl string, key string, data string, nanos long, is_delete boolean").withColumn("logical", F.lit(0))
    out = {r.nanos: r.reason for r in mapping.refused(df, table).collect()}
    assert out == {2: "values that don't fit: v", 3: "values that don't fit: v, at", 5: "missing keys: k", 6: "missing keys: k", 7: "unexpected columns: z", 9: "a delete's key has another length", 10: "a delete's key doesn't fit", 11: "a delete's key has another length"}


def test_compacted_checkpoints_have_the_same_window(spark):
    rng = random.Random(8)
    for _ in range(6):
        log = [("g", f"p{rng.randrange(3)}", rng.randrange(20), rng.randrange(3), rng.random() < 0.6) for _ in range(25)]
        df = spark.createDataFrame(log, "grp string, part string, nanos long, logical int, applied boolean")
        small = checkpoint.compact(df)
        assert rows(checkpoint.refresh(small)) == rows(checkpoint.refresh(df)) and small.count() <= df.distinct().count()


@pytest.mark.parametrize("a, b, same", [('{"a":1}', '{"a":"1"}', True), ("1E+2", "100", True), ('"x 1.50"', '"x 1.5"', False), ("true", '"true"', False), ("null", "null", True), (None, "null", False), (None, None, True), ("[1,[2.0]]", '["1",["2"]]', True), ("[1,2]", "[2,1]", False), ("[1", "[1", True), ('{"a":{"b":0.12345678901234567890123456789012345678901}}', '{"a":{"b":"0.12345678901234567890123456789012345678901"}}', True), ('{"a\\"1":2}', '{"a\\"1":2.0}', True)])
def test_same_value(spark, a, b, same):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    assert row.select(values.same_value(F.col("a"), F.col("b")).alias("x")).first().x == same


def test_gzip_values(spark):
    raw = [b"", b"x" * 1024, b"x" * 1025, random.Random(3).randbytes(3000), None]
    out = spark.createDataFrame([(r,) for r in raw], "raw binary").select("raw", values.gzip_value("raw").alias("kept")).withColumn("back", values.gunzip_value("kept")).collect()
    assert [r.back for r in out] == raw and [r.kept == r.raw for r in out] == [True, True, False, True, True]


@pytest.mark.parametrize("text, kind", [("x", "RAW(16)"), ("2024-01-01T00:00:00", "TIMESTAMP(6) WITH TIME ZONE"), ("2024-01-01", "TIMESTAMP(3)"), ("2024-01-01T00:00:00Z", "DATE")])
def test_typed_texts_of_another_form(spark, text, kind):
    assert spark.range(1).select(values.typed_text(F.lit(None).cast("string"), kind).alias("x")).first().x is None
    with pytest.raises(Exception, match="no "):
        spark.range(1).select(values.typed_text(F.lit(text), kind)).collect()


@pytest.mark.parametrize("a, b, flavor, less", [("", "s:1", "mysql", True), ("s:1", "", "mysql", False), ("", "", "mysql", False), (None, "s:1", "mysql", True), ("s:5,t:1-2", "t:1-3, s:1-9", "mysql", True), ("s:1-3:7", "s:1-6", "mysql", False), ("0-1-5", "0-1-6", "mariadb", True), ("0-1-5,1-1-1", "0-1-6", "mariadb", False)])
def test_gtid_less(spark, a, b, flavor, less):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    assert row.select(logical.gtid_less(F.col("a"), F.col("b"), flavor).alias("x")).first().x == less


def test_a_catalog_from_an_information_schema(spark):
    info = spark.createDataFrame([("t", "v", "string", 2, False, False, None), ("t", "k", "long", 1, True, False, None), ("t", "k", "long", 1, False, False, None), ("t", "g", "int", 3, False, True, None)], "tbl string, column_name string, kind string, ordinal int, is_key boolean, is_generated boolean, default string")
    table = Catalog.described(info).tables["t"]
    assert [(c.name, c.type, c.primary, c.generated) for c in table.columns] == [("k", "long", True, False), ("v", "string", False, False), ("g", "int", False, True)]
