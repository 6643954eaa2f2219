import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tidelog.llm import packing
from tidelog.llm.queries import tokenizer

PATH, PATTERN = tokenizer("byte_bpe_50k.json")


def cost(at, price, cuts):
    total = 0.0
    for i, j in zip(cuts, cuts[1:]):
        size = at[j] - at[i]
        assert size <= packing.CAP
        total += (0 if size in packing.POWERS else packing.CAP - size) + price[j] + packing.WINDOW_COST
    return total


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(40):
        steps = [rng.choice([1, 40, 256, 500, 512]) for _ in range(rng.randrange(1, 40))]
        at = np.concatenate(([0], np.cumsum(steps)))
        price = np.array([0.0] + [rng.choice([0.0, 8.0, 64.0]) for _ in steps])
        best = [0.0] + [float("inf")] * len(steps)
        for j in range(1, len(at)):
            for i in range(j):
                size = at[j] - at[i]
                if size <= packing.CAP:
                    best[j] = min(best[j], best[i] + (0 if size in packing.POWERS else packing.CAP - size) + price[j] + packing.WINDOW_COST)
        assert abs(cost(at, price, packing.best_cuts(at, price)) - best[-1]) < 1e-9


def test_tails_need_little_padding():
    for size in (1, 3, 127, 128, 1024, 1025, 1500, 1800, 2047, 2048):
        cuts = packing.whole_tail(np.array([0, 2000, 2000 + size]))
        parts = np.diff(cuts).tolist()
        assert parts[0] == 2000 and sum(parts) == 2000 + size
        assert all(p & (p - 1) == 0 and p >= 128 for p in parts[1:-1])
        assert len([p for p in parts[1:] if p < 128]) <= 1
        assert 2048 - size <= packing.TAIL_PADDING or all(p & (p - 1) == 0 or p < 128 for p in parts[1:])


def test_few_short_sequences_over_many_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = packing.query(docs.repartition(211), PATH, PATTERN).groupBy("sequence_id").agg({"length": "sum"}).toPandas()["sum(length)"]
    assert (sizes < 128).mean() < 0.01
    assert sum(2048 - s for s in sizes if s & (s - 1)) < 0.01 * sizes.sum()


def check(docs, out):
    model = Tokenizer.from_file(PATH)
    ids = {i: np.array([*model.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in docs}
    pieces, sequences = {}, {}
    for r in out:
        mine = ids[r.doc_id]
        assert r.doc_tokens == len(mine) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(mine[r.start : r.start + r.length].tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, mine in ids.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(mine)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        sizes.append(at)
    return sizes


def test_every_id_is_packed_once(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice(["word ", "Ünï. ", "x", "end! ", "\n", "9 "]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 30, 800, 6000]))) for i in range(60)] + [(100, None), (101, "x" * 30_000), (102, "<|endoftext|> it's"), (103, "x<|endoftext|>y"), (104, "a <|endoftext|> <|endoftext|><|endoftext"), (105, "<|endoftext|>" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS start").coalesce(1)
    sizes = check(docs, packing.query(df, PATH, PATTERN).collect())
    assert sum(2048 - s for s in sizes if s & (s - 1)) < 0.03 * sum(sizes) + packing.TAIL_PADDING
    assert packing.query(df.where("false"), PATH, PATTERN).count() == 0


def test_plans_that_are_carried_on():
    rng = random.Random(5)
    ends = np.zeros(10, bool)
    ends[7] = True
    whole, old = [], packing.PLAN_TOKENS
    packing.PLAN_TOKENS = 5000
    try:
        packer, rows = packing.Packer(3, ends), []
        for i in range(50):
            ids = np.array([rng.randrange(10) for _ in range(rng.choice([1, 50, 3000, 9000]))], "<u4")
            whole.append(ids)
            rows += packer.add(i, ids)
        rows += packer.flush(last=True)
    finally:
        packing.PLAN_TOKENS = old
    line = b"".join(r[3] for r in rows)
    assert line == np.concatenate(whole).tobytes()  # in order, nothing lost
    for d, start, length, ids, total, _, _ in rows:
        assert whole[d][start : start + length].tobytes() == ids and total == len(whole[d])
    place = {}
    for *_, length, ids, _, sequence, offset in [(r[2], r[3], r[4], r[5], r[6]) for r in rows]:
        assert place.get(sequence, 0) == offset
        place[sequence] = offset + length
    assert max(place.values()) <= 2048 and sorted(place) == list(range(3 << 32, (3 << 32) + len(place)))
