import hashlib
import random
import zlib

import numpy as np
import pytest

from tidelog.llm import media


def payloads():
    rng = random.Random(3)
    texts = [b"", b"a", bytes(range(256)) * 3, b"\xff" * 700, b"\x80" * 1000, b"\x7f\x80" * 500, b" " * 192]
    texts += [bytes(rng.choice(b"abc \xff\x00\xc3\xa9") for _ in range(rng.randrange(3000))) for _ in range(60)]
    texts.append(bytes(rng.randrange(256) for _ in range(50_000)))
    return [media.padded(t) for t in texts]


def test_payloads_come_back():
    p = payloads()
    files = media.write(p)
    assert files == [media.write([x])[0] for x in p]  # the batch doesn't matter
    found = media.read(files)
    assert [f.payload for f in found] == p
    assert [media.read([x])[0].thumb_hash for x in files[:5]] == [f.thumb_hash for f in found[:5]]


def by_hand(blocks, lengths_dc, lengths_ac, components, width, height, quant):
    """A scan written bit by bit, without restarts; blocks: (component, 64 coefficients) in scan order."""
    code = {k: {s: (c, n) for s, c, n in media.codes_of(*media.table_of(t))} for k, t in (("dc", lengths_dc), ("ac", lengths_ac))}
    bits, last = "", {}

    def put(kind, symbol, value=0):
        c, n = code[kind][symbol]
        size = symbol & 15
        out = format(c, f"0{n}b")
        return out + (format(value if value >= 0 else value + (1 << size) - 1, f"0{size}b") if size else "")

    for component, values in blocks:
        diff = values[0] - last.get(component, 0)
        last[component] = values[0]
        bits += put("dc", abs(diff).bit_length(), diff)
        run = 0
        top = max((k for k in range(1, 64) if values[k]), default=0)
        for k in range(1, top + 1):
            if not values[k]:
                run += 1
                continue
            while run > 15:
                bits += put("ac", 0xF0)
                run -= 16
            bits += put("ac", run << 4 | abs(values[k]).bit_length(), values[k])
            run = 0
        if top < 63:
            bits += put("ac", 0)
    bits += "1" * (-len(bits) % 8)
    data = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    head = b"\xff\xd8" + media._segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + media._segment(0xDB, bytes([0, *quant]))
    head += media._segment(0xC0, bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(components)]) + b"".join(bytes([i + 1, hv, 0]) for i, hv in enumerate(components)))
    head += media._segment(0xC4, b"\0" + b"".join(media.table_of(lengths_dc))) + media._segment(0xC4, b"\x10" + b"".join(media.table_of(lengths_ac)))
    return head + media._segment(0xDA, bytes([len(components)]) + b"".join(bytes([i + 1, 0]) for i in range(len(components))) + b"\0\x3f\0") + data + b"\xff\xd9"


DC = {s: 4 for s in range(12)}
AC = {0: 2, 0xF0: 3} | {run << 4 | size: 8 for run in range(6) for size in range(1, 11)} | {run << 4 | size: 16 for run in range(6, 16) for size in range(1, 11)}


@pytest.mark.parametrize("components, size", [((0x11,), (20, 12)), ((0x22, 0x11, 0x11), (20, 30)), ((0x21, 0x11, 0x11), (16, 8)), ((0x22,), (24, 16))])
def test_other_files(components, size):
    """Runs of zeros, long codes, large values, subsampled colours, one component."""
    rng = random.Random(11)
    width, height = size
    wide, high = (max(c >> 4 for c in components), max(c & 15 for c in components)) if len(components) > 1 else (1, 1)
    across, down = -(-width // (8 * wide)), -(-height // (8 * high))
    layout = [(i, k) for i, c in enumerate(components) for k in range((c >> 4) * (c & 15) if len(components) > 1 else 1)]
    blocks = [(i, [rng.randrange(-900, 900)] + [rng.choice([0, 0, 0, 0, 0, 1, -3, 700]) if rng.random() < 0.5 else 0 for _ in range(63)]) for _ in range(across * down) for i, _ in layout]
    quant = [3] + [1] * 63
    file = by_hand(blocks, DC, AC, components, width, height, quant)
    scan = media.parse(file)
    assert media.coefficients([scan]).tolist() == [v for _, v in blocks]
    row = media.read([file])[0]
    assert (row.width, row.height, row.payload) == (width, height, None)
    h, v = (components[0] >> 4, components[0] & 15) if len(components) > 1 else (1, 1)
    first = [b[1][0] for b in blocks if b[0] == 0]
    for unit in range(across * down):
        for k in range(h * v):
            y, x = unit // across * v + k // h, unit % across * h + k % h
            if y < row.thumbnail.shape[0] and x < row.thumbnail.shape[1]:
                assert row.thumbnail[y, x] == min(255, max(0, first[unit * h * v + k] * 3 // 8 + 128))


def test_broken_files_dont_spoil_others():
    good = media.write(payloads()[:3])
    cut = good[2][: len(good[2]) // 2]
    found = media.read([good[0], None, b"", b"no image", cut, good[1], good[0][:40]])
    assert [f is None for f in found] == [False, True, True, True, True, False, True]


def test_query(spark):
    texts = [(1, "ab"), (2, None), (3, ""), (4, "é" * 500), (4, "é" * 500), (None, "x" * 40_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS media", "2 AS data")
    out = media.query(df).collect()
    assert len(out) == len(texts)
    for r in out:
        data = next((t or "").encode() for i, t in texts if i == r.doc_id)
        p = media.padded(data)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        assert r.media_sha256 == hashlib.sha256(media.write([p])[0]).hexdigest() and r.media_bytes == len(media.write([p])[0]) and r.feature
    assert media.query(df.where("false")).count() == 0


def test_made_columns_replace_others_of_their_names(spark):
    df = spark.createDataFrame([(1, bytearray(b"abc"), "m", "w", "p", 5)], "id long, data binary, media string, width string, payload string, other long")
    stored = media.store(df, "data")
    assert sorted(stored.columns) == sorted(df.columns)
    row = media.with_features(stored).first()
    assert (row.id, row.other, bytes(row.data)) == (1, 5, b"abc") and row.width > 0 and bytes(row.payload) == media.padded(b"abc")


def test_lookup_covers_values():
    table = media.lookup(*media.table_of(media.AC_LENGTHS))
    assert int(table.length.max()) == 9 and np.all(table.whole <= 16)
