import math
import random
import zlib
from collections import defaultdict

import numpy as np

from pyspark.sql import functions as F

from tidelog.llm import langid


def brute_model(texts):
    """Interpolated Kneser-Ney by dictionaries: probability of a character after its context."""
    n = langid.ORDER
    folded = [[int(c) for c in langid.fold(t)] for t in texts]
    grams = defaultdict(int)
    for f in folded:
        for i in range(n - 1, len(f)):
            grams[tuple(f[i - n + 1 : i + 1])] += 1
    counts = {n: dict(grams)}
    for k in range(n - 1, 0, -1):
        lower = defaultdict(int)
        for g in counts[k + 1]:
            lower[g[1:]] += 1
        counts[k] = dict(lower)

    def p(context, c):
        k = len(context) + 1
        below = p(context[1:], c) if context else 1 / langid.ALPHABET
        following = [m for g, m in counts[k].items() if g[:-1] == context]
        if not following:
            return below
        total, d = sum(following), langid.DISCOUNT
        return max(counts[k].get((*context, c), 0) - d, 0) / total + d * len(following) / total * below

    return p


def test_probabilities_equal_the_formula():
    samples = {"x": ["abracadabra, abra 12 Äb", "cab bac"], "y": ["the cat sat", "that hat"]}
    model = langid.train(samples)
    for text in ("abra that", "Zebra", "a", "çab 7 the"):
        entropy, n, _ = model.entropies([text])
        f = [int(c) for c in langid.fold(text)]
        assert n[0] == len(f) - langid.ORDER + 1
        for column, name in enumerate(model.languages):
            p = brute_model(samples[name])
            expected = -sum(math.log(p(tuple(f[i - 3 : i]), f[i])) for i in range(3, len(f))) / n[0]
            assert abs(entropy[0, column] - expected) < 1e-4


def test_batches_dont_matter(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abc dé9") for _ in range(rng.randrange(50))) for _ in range(40)] + [None, "", "123 !"]
    model = langid.train({"x": texts[:20], "y": [t.upper() + "q" for t in texts[20:40]]})
    whole = model.entropies(texts)[0]
    monkeypatch.setattr(langid, "CHUNK", 10)
    assert np.allclose(whole, np.concatenate([model.entropies([t])[0] for t in texts]))
    assert np.allclose(whole, model.entropies(texts)[0])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.query(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out) and sum(r.accepted for r in out) >= 0.99 * len(out)


def test_lang_source_and_fold_are_no_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    held = langid.held_out()
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(map(tuple, langid.query(docs).collect())) == sorted(map(tuple, langid.query(other).collect()))


def test_edge_cases(spark):
    english = [(i, f"the cat number {i} sat on the mat and then it went home again", "en") for i in range(40)]
    german = [(100 + i, f"der hund nummer {i} lief über die straße und kam dann nicht zurück", "de") for i in range(40)]
    odd = [(300, None, "en"), (301, "", "en"), (302, "123 !?", None), (303, "日本語", None), (None, "the dog", None), (305, "the dog", None), (305, "the dog", None), (306, "xq" * 30_000, None)]
    df = spark.createDataFrame(english + german + odd, "doc_id long, text string, lang string").selectExpr("*", "1 AS lang_pred", "2 AS held_out")
    out = langid.query(df).collect()
    assert len(out) == 88
    found = {r.doc_id: r for r in out}
    assert [found[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and not any(found[i].accepted for i in (300, 301, 302, 306))
    assert found[None].lang_pred == found[305].lang_pred == "en" and found[303].lang_pred in ("de", "en")
    kept = langid.keep_accepted(df)
    stay = {r.doc_id for r in kept.collect()}
    assert {r.lang_pred for r in kept.collect()} == {1}
    assert kept.columns == df.columns and stay >= set(range(40)) | set(range(100, 140)) and not stay & {300, 301, 302, 306}
    assert langid.query(df.where("false")).count() == 0
    unlabelled = langid.query(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"} and sum(r.accepted for r in unlabelled) == 85


def test_every_labelled_language_is_learned(spark):
    """However many there are, and wherever in the alphabet: each has letters of its own."""
    rng = random.Random(7)
    text = lambda k: " ".join("".join(chr(0x4E00 + 8 * k + rng.randrange(8)) for _ in range(6)) for _ in range(6))
    rows = [(8 * k + j, text(k), f"l{k:03}") for k in range(210) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.query(df).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    assert langid.keep_accepted(df).where("lang >= 'l200'").count() >= 79
