import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidelog.llm import graph, simhash


def fingerprint(text, words=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def classes(items, linked):
    """Smallest item that each one reaches."""
    parent = {i: i for i in items}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in items:
        for y in items:
            if x < y and linked(x, y):
                a, b = top(x), top(y)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in items}


def corpus():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    docs = {}
    for i in range(60):
        docs[i] = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 30, 400, 900]))]
    for i in range(60, 160):
        base = list(docs[rng.randrange(60)])
        for _ in range(rng.choice([0, 1, 2, 5])):
            if base:
                base[rng.randrange(len(base))] = rng.choice(words)
        docs[i] = base
    sep = [" ", "\n", "  ", "\t", "\x0b"]
    return [(i, "".join(w.upper() + rng.choice(sep) if rng.random() < 0.2 else w + rng.choice(sep) for w in d)) for i, d in docs.items()] + [(500, None), (501, ""), (502, "\x1c \x85")]


@pytest.mark.parametrize("crowd", [48, 1])
def test_query_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS print")
    made = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(df).collect()}
    prints = {i: fingerprint(t) for i, t in docs}
    expected = classes(list(prints), lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 2)
    assert made == {i: (f"{prints[i]:016x}", expected[i]) for i in prints}


@pytest.mark.parametrize("crowd", [48, 1])
def test_dense_fingerprints(spark, monkeypatch, crowd):
    """Links among fingerprints that crowd grid points, at both ends of the segments' counts too."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(8)
    prints = set()
    for base in (0, 2**64 - 1, rng.getrandbits(64)):
        for _ in range(40):
            x = base
            for _ in range(rng.randrange(7)):
                x ^= 1 << rng.randrange(20)
            prints.add(x)
    signed = [int(np.uint64(x).view(np.int64)) for x in prints]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "print long"))
    found = {r.node: r.component for r in graph.components(edges).collect()}
    unsigned = lambda x: x & (2**64 - 1)
    expected = classes(signed, lambda x, y: (unsigned(x) ^ unsigned(y)).bit_count() <= 2)
    assert {x: found.get(x, x) for x in signed} == expected


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 2000), (3000, 2000), (5, 5), (7, 6)]
    made = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert made == {i: 0 for i in range(201)} | {1000: 1000, 2000: 1000, 3000: 1000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_similar_class_stays(spark):
    docs = corpus()
    rng = random.Random(10)
    long = [w for i, t in docs if t and len(t.split()) > 300 for w in t.split()[:200]][:200]
    for k in range(30):  # near copies: one word changed
        copy = list(long)
        copy[rng.randrange(200)] = f"new{k}"
        docs.append((700 + k, " ".join(copy)))
    docs += [(None, "a text without a number that is like no other"), (None, "another text without a number"), (900, docs[40][1]), (docs[3][0], "one more text of a doc_id that is there already")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS node", "'x' AS component")
    kept = simhash.keep_firsts(df)
    assert kept.columns == df.columns
    sets = {n: set(simhash._shingle_set((t or "").encode(), 5).tolist()) for n, (_, t) in enumerate(docs)}
    like = lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])
    groups = defaultdict(list)
    for n, c in classes(list(sets), like).items():
        groups[c].append(n)
    order = lambda n: 2**63 - 1 if docs[n][0] is None else docs[n][0]
    found = sorted((2**63 - 1 if r.doc_id is None else r.doc_id) for r in kept.collect())
    assert found == sorted(min(order(n) for n in g) for g in groups.values())


@pytest.mark.parametrize("block", [256, 8])
def test_crowded_samples_lose_no_pair(spark, monkeypatch, block):
    """Documents that share a long passage, below the similarity, fill the places before a document; pairs above it are found all the same."""
    monkeypatch.setattr(simhash, "NEIGHBOURS", 1)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(304)]
    own = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    docs = [" ".join(passage + own(60)) for _ in range(120)]
    for _ in range(15):  # pairs at 0.818: 300 + 24 shingles of 396 are shared
        common = own(24)
        docs += [" ".join(passage + common + own(36)) for _ in range(2)]
    docs += [" ".join(passage + own(rng.randrange(80, 400))) for _ in range(20)]
    close = passage + own(60)
    docs += [" ".join([*close[: 305 + k], f"n{k}", *close[306 + k :]]) for k in range(40)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = {r.id: r.component for r in simhash.similar(df).collect()}
    sets = {i: set(simhash._shingle_set(t.encode(), 5).tolist()) for i, t in enumerate(docs)}
    expected = classes(list(sets), lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))
    assert len({(found[i], expected[i]) for i in found}) == len(set(found.values())) == len(set(expected.values())) < len(docs) - 50


def test_near_copies_meet_in_the_grid(spark, small, monkeypatch):
    """The pipeline's stage links whole texts' fingerprints by the operator's method; samples come on top of that."""
    rng = random.Random(14)
    texts = [[f"w{rng.getrandbits(12)}" for _ in range(2000)] for _ in range(12)]
    docs = [" ".join(t) for t in texts] + [" ".join([*t[:k * 100], f"n{k}", *t[k * 100 + 1 :]]) for k, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    seen, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints: seen.extend(r.print for r in prints.collect()) or links(prints))
    monkeypatch.setattr(simhash, "_sample_pairs", lambda views, _: views.selectExpr("node AS a", "node AS b").where("false"))
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, df, small).collect()}
    assert set(seen) == {r.print for r in simhash.with_prints(df, 5).collect()}
    by_grid = {r.id: r.component for r in simhash.classes(df).collect()}
    assert kept == set(by_grid.values()) and len(kept) < 18


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.query(df).count() == 0 and simhash.keep_firsts(df).count() == 0
