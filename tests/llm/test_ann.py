import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import ann

SCHEMA = "vec_id long, embedding array<float>, list int"


def clean(rows, d):
    return [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and v and len(v) == d and all(x is not None and math.isfinite(x) for x in v) and any(v)]


def brute(rows, query):
    out = [(-float(ann.cosines(query[1], v[None])[0]), i) for i, v in rows if i != query[0]]
    return [(i, -s) for s, i in sorted(out)[:5]]


def corpus(n, d=16, copies=0):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, d)) * 3
    rows = [(i, (centres[i % 8] + rng.standard_normal(d)).tolist(), 0) for i in range(n)]
    same = rows[0][1]
    return rows + [(n + i, same, 0) for i in range(copies)]


def test_small_tables_are_searched_whole(spark):
    rows = corpus(300, copies=40)
    odd = [(1000, None, 0), (1050, [], 0), (1100, [0.0] * 16, 0), (1150, [float("nan")] * 16, 0), (1200, [float("inf")] + [1.0] * 15, 0), (1250, [None] + [1.0] * 15, 0), (1300, [1.0] * 7, 0), (None, [1.0] * 16, 0), (50, rows[50][1], 0)]
    out = ann.query(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    usable = clean(rows + odd, 16)
    queries = {i: v for i, v in usable if i % 50 == 0}
    found = {}
    for r in out:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(queries)
    for i, v in queries.items():
        mine = sorted(found[i], key=lambda r: r["rank"])
        expected = brute(usable, (i, v))
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert [(r.vec_id, r.score) for r in mine] == expected


def test_fewer_candidates_than_asked(spark):
    out = ann.query(spark.createDataFrame(corpus(51)[:1] + corpus(51)[48:], SCHEMA)).collect()
    assert sorted((r.query_id, r["rank"]) for r in out) == [(0, 1), (0, 2), (0, 3), (50, 1), (50, 2), (50, 3)]


def test_empty_and_useless_tables(spark):
    assert ann.query(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ann.query(spark.createDataFrame([(0, None, 0), (50, [0.0], 0)], SCHEMA)).count() == 0


@pytest.mark.parametrize("cell_rows, cell_queries", [(20_000, 2_000), (100, 7)])
def test_recall(spark, monkeypatch, cell_rows, cell_queries):
    monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(ann, "CELL_QUERIES", cell_queries)
    monkeypatch.setattr(ann, "LEAST_PROBED", 1)
    rows = corpus(4000, copies=1200)
    out = ann.query(spark.createDataFrame(rows, SCHEMA)).collect()
    usable = clean(rows, 16)
    queries = [q for q in usable if q[0] % 50 == 0]
    found = {}
    for r in out:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(found[i]) == 5 for i, _ in queries)
    hits = sum(len(found[q[0]] & {i for i, _ in brute(usable, q)}) for q in random.Random(1).sample(queries, 40))
    assert hits >= 0.9 * 200


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(5)
    vectors = ann.units(rng.standard_normal((9000, 64))) @ ann.rotation(64)
    hits = 0
    for q in vectors[:30]:
        kept = ann.scan(q, vectors)
        best = np.argsort(((vectors - q) ** 2).sum(axis=1), kind="stable")[:5]
        hits += len(set(kept.tolist()) & set(best.tolist()))
    assert hits >= 0.97 * 150


def test_rotation_keeps_distances():
    turn = ann.rotation(24)
    assert np.allclose(turn @ turn.T, np.eye(24))


def test_any_rows_can_ask(spark):
    df = spark.createDataFrame(corpus(100), SCHEMA)
    assert {r.query_id for r in ann.search(df, F.col("vec_id") < 3).collect()} == {0, 1, 2}


def test_vectors_without_clusters(spark):
    """Where no list is near, many are scanned."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(32).tolist(), 0) for i in range(3000)]
    out = ann.query(spark.createDataFrame(rows, SCHEMA)).collect()
    usable = clean(rows, 32)
    found = {}
    for r in out:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found[q[0]] & {i for i, _ in brute(usable, q)}) for q in usable[::150])
    assert hits >= 0.9 * 5 * len(usable[::150])


def test_rows_that_share_a_vec_id(spark):
    """Repeats come out once and take no other's place; a query with two vectors asks with both."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(16).tolist(), 0) for i in range(1, 60)]
    other = rng.standard_normal(16).tolist()
    rows += [rows[6]] * 20 + [(7, other, 0), (50, rows[6][1], 0)]
    out = sorted(ann.query(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["rank"])
    asked = [np.array(v, np.float32).astype(float) for i, v, _ in rows if i == 50]
    cosine = lambda x, y: x @ y / np.sqrt((x @ x) * (y @ y))
    scores = {(i, round(float(cosine(q, np.array(v, np.float32).astype(float))), 9)) for i, v, _ in rows if i != 50 for q in asked}
    assert [(r.vec_id, round(r.score, 9)) for r in out] == sorted(scores, key=lambda x: (-x[1], x[0]))[:5]
    assert [r["rank"] for r in out] == [1, 2, 3, 4, 5] and {r.query_id for r in out} == {50}
