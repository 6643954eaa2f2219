import hashlib
import random

import numpy as np
import pytest

from tidelog.llm import suffix_dedup


def brute(docs):
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, t in sorted(docs, key=lambda d: order(d[0])):
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], order(i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < order(i):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(20) for _ in range(6)]
    docs = []
    for i in rng.sample(range(1000), 90):
        parts = [rng.choice(passages) if rng.random() < 0.4 else text(rng.randrange(1, 25)) for _ in range(rng.randrange(1, 6))]
        docs.append((i, " ".join(parts)))
    docs += [(2000 + k, docs[k][1]) for k in range(5)] + [(2010 + k, docs[k][1][3:-2] + "x") for k in range(5)]
    docs += [(3000, None), (3001, ""), (3002, "x" * 49), (3003, "y" * 49), (3004, "ab" * 400), (3005, "ab" * 30), (3006, "ab" * 500), (None, docs[0][1]), (None, docs[7][1] + "z"), docs[11], (docs[12][0], "clash " + docs[13][1])]
    docs += [(4000 + k, passages[0] + f" {k} " + passages[1]) for k in range(40)]
    return docs


@pytest.mark.parametrize("seed, batch, bucket", [(1, 4_000_000, 64 << 20), (2, 500, 64 << 20), (3, 4_000_000, 1000)])
def test_query_equals_brute_force(spark, monkeypatch, seed, batch, bucket):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "'x' AS bucket").repartition(3)
    made = sorted((tuple(r) for r in suffix_dedup.query(df).collect()), key=str)
    assert made == brute(docs)


def test_longest_previous_factor():
    rng = random.Random(4)
    data = bytes(rng.choice(b"ab") for _ in range(400))
    owner = np.sort(np.array([rng.randrange(6) for _ in range(340)]))
    made = suffix_dedup.longest_previous_factor(np.frombuffer(data, np.uint8), np.arange(340), owner)
    for p in range(340):
        best = 0
        for q in range(340):
            if owner[q] < owner[p]:
                n = 0
                while n < 50 and data[p + n] == data[q + n]:
                    n += 1
                best = max(best, n)
        assert made[p] == best


def test_nearest_smaller():
    rng = random.Random(2)
    for n in (0, 1, 2, 300):
        v = np.array([rng.randrange(20) for _ in range(n)])
        assert suffix_dedup.previous_smaller(v).tolist() == [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert suffix_dedup.next_smaller(v).tolist() == [min((j for j in range(i + 1, n) if v[j] < v[i]), default=-1) for i in range(n)]


def test_documents_without_later_copies(spark):
    passage = "a passage that is far longer than fifty bytes, as passages are — é"
    df = spark.createDataFrame([(1, f"one {passage} end", 5), (2, f"two {passage} fin", 5), (3, f"one {passage} end", 5), (4, None, 5), (5, "", 5)], "doc_id long, text string, n_chars long")
    assert suffix_dedup.dedup_documents(df.union(df)).count() == 8
    out = {r.doc_id: r.text for r in suffix_dedup.dedup_documents(df).collect()}
    assert set(out) == {1, 2, 4, 5} and out[1] == f"one {passage} end" and out[2] == "twofin" and out[4] is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.query(df).count() == 0 and suffix_dedup.dedup_documents(df).count() == 0
