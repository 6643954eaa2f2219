import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import bpe
from tidelog.llm.queries import tokenizer

PATH, PATTERN = tokenizer("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in bpe.load(PATH, PATTERN).encode_batch(texts)]


def test_fixed_texts(reference):
    rng = random.Random(1)
    texts = ["", " ", "a" * 1000, "ab" * 700, "x y\x1c\x85  z", "it's don'T 12³½ Ⅷ ٣", "日本語テキスト", "é" * 600, "<|endoftext|>", "\n\n  \n x", "Aa" * 5000, " " * 3000, "." * 255, "." * 256, "." * 257, None]
    texts += ["".join(rng.choice("abcdehinost   \n0123.,'é") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x24F), rng.randint(0x250, 0xD7FF), rng.randint(0xE000, 0x10FFFF), 32, 39, 115])) for _ in range(40)) for _ in range(500)]
    texts += [f"a{c}1{c} {c}{c}!{c}\n{c}" for c in map(chr, (0x558, 0x11DE0, 0x3D000, 0x1C89, 0x10EC2))]
    texts += ["".join(rng.choice("ab") for _ in range(n)) for n in (127, 128, 129, 254, 255, 256, 257, 2000)]
    assert ids(texts) == [reference.encode_ordinary(t or "") for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=0x24F), max_size=60))
def test_any_latin_text(text):
    model = bpe.load(PATH, PATTERN)
    encoded = model.encode_batch([text])[0]
    assert model.decode(encoded) == text.encode()


def test_matrix_and_heap_agree():
    model, rng = bpe.load(PATH, PATTERN), random.Random(3)
    pieces = [bytes(rng.choice(b"the and of\xc3\xa9") for _ in range(n)) for n in (1, 2, 3, 17, 64, 65, 200, 256)]
    for made, piece in zip(model.merge(pieces), pieces):
        assert made.tolist() == model._merge_long(piece).tolist()


def test_forgetting_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    texts = ["some words here", "other words there", "some words again"] * 3
    assert [ids([t])[0] for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_query(spark, reference):
    texts = [(1, "Hello, world's end"), (2, None), (3, ""), (3, ""), (None, "é" * 3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    out = bpe.query(df, PATH, PATTERN).collect()
    assert len(out) == len(texts)
    for r in out:
        text = next(t for i, t in texts if i == r.doc_id) or ""
        expected = reference.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(expected), hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.query(df.where("false"), PATH, PATTERN).count() == 0
