import math
import struct
import zlib
from collections import Counter

import xxhash

from tidelog.llm import sharding


def test_query(spark):
    docs = [(i, "é" * (i % 7) if i % 5 else None) for i in range(4000)] + [(None, "x"), (7, "again"), (7, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS slot").repartition(5)
    out = sharding.query(df).collect()
    assert len(out) == len(docs)
    texts = dict(docs[:4000])
    for r in out:
        if r.doc_id is not None and r.doc_id != 7:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert r.law == "key" and r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 40
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) < 160 and min(counts.values()) > 55
    moved = sum(r.grown_shard == 40 for r in out)
    assert 50 < moved < 160
    assert len({r.shard for r in out if r.doc_id == 7}) == 1
    assert sharding.query(df.where("false")).count() == 0


def place(spark, tree, n=6000):
    return {r.id: r.s for r in sharding.place(spark.range(n), "id", tree, "s").collect()}


def test_weights_move_rows_within_changed_subtrees(spark):
    old = {"a": {"a0": {0: 1.0, 1: 1.0}, "a1": {2: 1.0}}, "b": {"b0": {3: 1.0}, "b1": {4: 1.0, 5: 2.0}}}
    new = {"a": {"a0": {0: 1.0, 1: 3.0}, "a1": {2: 1.0}}, "b": old["b"]}
    x, y = place(spark, sharding.Tree(old)), place(spark, sharding.Tree(new))
    region = lambda s: "a" if s < 3 else "b"
    assert all(region(x[i]) == region(y[i]) or region(y[i]) == "a" for i in x)  # rows come into the region that grew, none leave it
    assert all(x[i] == y[i] for i in x if region(x[i]) == region(y[i]) == "b")
    counts = Counter(x.values())
    assert abs(counts[5] - 2 * counts[4]) < 0.25 * counts[5] and abs(counts[3] - counts[0]) < 0.25 * counts[3]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for n in (40, 41, 47, 48):
        x, y = place(spark, sharding.Tree.uniform(n), 2000), place(spark, sharding.Tree.uniform(n + 1), 2000)
        assert all(y[i] in (x[i], n) for i in x) and any(y[i] == n for i in y)
    assert sharding.Tree.uniform(41).shards() == list(range(41))


def descend(tree, key):
    """The shard of a key, one draw after another."""

    def choice(weights, prefix):
        def draw(child):
            seed = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
            u = ((xxhash.xxh64_intdigest(f"{prefix}/{child}".encode(), seed) >> 11) + 1) / 2**53
            return math.log(u) / weights[child]

        return max(weights, key=draw)

    total = lambda shards: sum(shards.values())
    region = choice({r: sum(map(total, racks.values())) for r, racks in tree.regions.items()}, "")
    rack = choice({n: total(shards) for n, shards in tree.regions[region].items()}, region)
    return choice(tree.regions[region][rack], rack)


def test_places_equal_brute_force(spark):
    odd = sharding.Tree({"a": {"a0": {0: 1.0, 1: 0.5}, "a1": {2: 4.0}}, "b": {"b0": {3: 1.0, 4: 2.5, 5: 0.25}}, "c": {"c0": {6: 7.0}}})
    for tree in (odd, sharding.Tree.uniform(40), sharding.Tree.uniform(43)):
        assert place(spark, tree, 3000) == {k: descend(tree, k) for k in range(3000)}
