"""Suffix-array dedup across documents (operator 3).

A byte goes if some 50-byte string that covers it also starts in a document with
a smaller doc_id. The longest-previous-factor array tells which: in suffix order, the
nearest entries before and after with a smaller document give the longest match
in any smaller document; positions whose longest match reaches 50 bytes lose
those 50 bytes.

One suffix array of a whole corpus doesn't fit a machine, so the work is dealt out
without losing a match:

1. Later copies of a whole text lose all of it (from 50 bytes on) and take no further part.
2. Every 50-byte window names an anchor, the 20-byte string of smallest hash in
   it. Equal windows have equal anchors. Anchors' hashes meet in buckets; those
   that occur in one document only are done with. A batch sends a hash once, however
   many of its documents hold it, so a passage that a third of all documents share
   reaches its bucket once a batch.
3. Each document sends, for its shared anchors, the stretch of text whose windows
   name that anchor (80 bytes at most). Equal stretches of one batch are settled
   there, and of one bucket as well; only anchors with differing stretches are left.
4. For these, suffix order, LCP and longest previous factors are computed in a bucket.
5. Removed windows go back to their documents, which are joined with them by key.

Answers travel as one packed row for each pair of bucket and destination.

Null texts count as empty, null doc_ids as larger than any other. Rows that share doc_id
and text have one result; rows that share doc_id alone don't remove from each other.
Documents under 50 bytes keep all. An empty table gives an empty result. Other columns
of the input don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import (
    NULL_ID,
    batches_of,
    join_groups,
    order_id,
    release_memory,
    shared_checkpoints,
    shuffle_partitions,
    small_batches,
    text_bytes,
    thrifty,
)

GRAM = 50
ANCHOR = 20
WINDOW = GRAM - ANCHOR + 1
HASH_MASK = np.uint64((1 << 48) - 1)
#: Bytes of text worked on at once; a longer text is worked on alone.
BATCH_BYTES = 2_000_000

_RNG = np.random.default_rng(7919)
_BYTE_HASH = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_MULTIPLIERS = _RNG.integers(0, 2**64, 6, dtype=np.uint64) | np.uint64(1)

#: Bytes of text for each bucket, at most; a bucket holds what of them is repeated.
BUCKET_BYTES = 64 << 20
PACKED = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
PACKED_DDL = "bucket int, payload binary"
GATHERED = pa.schema([("id", pa.int64()), ("row_hash", pa.int64()), ("found", pa.binary())])
GATHERED_DDL = "id long, row_hash long, found binary"


# ---------------------------------------------------------------- anchors


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the size bytes that start at each position."""
    h, step = _BYTE_HASH[data], 1
    for m in _MULTIPLIERS:
        if step == size:
            return h
        more = min(step, size - step)  # the last part may overlap the one before
        h = (h[:-more] * m) + h[more:]
        h ^= h >> np.uint64(31)
        step += more
    return h


def hashes_at(data: np.ndarray, positions: np.ndarray, size: int) -> np.ndarray:
    """Another hash of the size bytes at some positions, where all positions' would be too many."""
    h = np.zeros(len(positions), np.uint64)
    for k in range(size):
        h = h * _MULTIPLIERS[0] + _BYTE_HASH[data[positions + k]]
        h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one anchor: document's index, hash, first window, number of windows, anchor's position.

    Documents are data[starts[i]:ends[i]]; windows don't cross them.
    """
    if len(data) < GRAM:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = string_hashes(data, ANCHOR)
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < WINDOW:
        rest = WINDOW - width
        low = np.minimum(low[:-rest], low[rest:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # at[p]: the anchor of the window at p
    change = np.empty(len(at), bool)
    change[0] = True
    np.not_equal(at[1:], at[:-1], out=change[1:])
    valid = np.ones(len(at), bool)
    long_enough = ends - starts >= GRAM
    for s, e in zip(starts.tolist(), ends.tolist()):
        if s < len(at):
            change[s] = True
            valid[max(s, e - GRAM + 1) : e] = False
            if (x := max(s, e - GRAM + 1)) < len(change):
                change[x] = True
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(at)))
    ok = valid[first]
    first, count = first[ok], count[ok]
    where = at[first]
    doc = np.searchsorted(starts[long_enough], first, side="right") - 1
    return np.flatnonzero(long_enough)[doc], h[where] & HASH_MASK, first, count, where


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(texts), np.uint8), ends - size, ends


def _by_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)


# ---------------------------------------------------------------- which anchors documents share


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64).tobytes()
    return head + b"".join(x.tobytes() for x in arrays)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8).tolist()
    at, out = 8 * (n + 1), []
    for size, kind in zip(sizes, types):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _texts(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """(ids, row hashes, texts, ...) of about BATCH_BYTES, sorted by id and row hash."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("id", "row_hash", "data", *more))):
            held.append(row)
            size += len(row[2])
            if size >= BATCH_BYTES:
                yield _sorted(held)
                held, size = [], 0
    if held:
        yield _sorted(held)


def _sorted(rows: list[tuple]) -> tuple:
    ids, keys, *rest = zip(*sorted(rows, key=lambda r: r[:2]))
    return (np.array(ids, np.int64), np.array(keys, np.int64), *rest)


def _runs(*sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal entries."""
    n = len(sorted_columns[0])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.zeros(n - 1, bool)
    for c in sorted_columns:
        change |= c[1:] != c[:-1]
    cut = np.flatnonzero(change) + 1
    return np.concatenate(([0], cut)), np.append(cut, n)


def send_anchors(buckets: int):
    """Rows (bucket, payload): hashes and the rows they stand in; a hash goes out for the smallest row of the batch alone.

    Rows that share a hash inside a batch need no answer: for them, payload carries the finished answer to any bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in _texts(batches):
            doc, h, *_ = anchors(*_joined(texts))
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            row = np.unique(np.stack((ids, keys), 1), axis=0, return_inverse=True)[1].ravel()  # rows that are repeated count as one
            again = np.zeros(len(h), bool)
            again[1:] = (h[1:] == h[:-1]) & (row[doc[1:]] == row[doc[:-1]])
            doc, h = doc[~again], h[~again]
            same = np.zeros(len(h) + 1, bool)
            same[1:-1] = h[1:] == h[:-1]
            asked, settled = ~same[:-1], same[:-1] | same[1:]
            out = []
            for chosen, kind, where in ((asked, b"\0", _by_bucket(h, buckets)), (settled, b"\1", doc % buckets)):
                idx = np.flatnonzero(chosen)
                idx = idx[np.lexsort((doc[idx], where[idx]))]
                for s, e in zip(*_runs(where[idx])):
                    part = idx[s:e]
                    out.append((int(where[part[0]]), kind * 8 + _pack_hashes(ids[doc[part]], keys[doc[part]], h[part])))
            yield from batches_of(out, PACKED)

    return run


def _pack_hashes(ids: np.ndarray, keys: np.ndarray, h: np.ndarray) -> bytes:
    """Sorted by id and key; hashes have six bytes."""
    start, end = _runs(ids, keys)
    return _pack(ids[start], keys[start], (end - start).astype(np.uint32), np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6])


def _unpack_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, keys, counts, six = _unpack(blob, np.int64, np.int64, np.uint32, np.uint8)
    h = np.zeros((len(six) // 6, 8), np.uint8)
    h[:, :6] = six.reshape(-1, 6)
    return np.repeat(ids, counts), np.repeat(keys, counts), h.view(np.uint64).ravel()


def _deal(ids: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(destination, indexes) of the entries, which are sorted by id and key."""
    where = ids % buckets
    order = np.argsort(where, kind="stable")
    for s, e in zip(*_runs(where[order])):
        yield int(where[order[s]]), order[s:e]


def answer_anchors(buckets: int):
    """Packed rows: the hashes that another row has as well, dealt out by the rows' ids."""

    def run(group: pa.Table) -> pa.Table:
        found, asked = [], []
        for payload in group.column("payload").to_pylist():
            (found if payload[0] else asked).append(_unpack_hashes(payload[8:]))
        if asked:
            ids, keys, h = (np.concatenate(x) for x in zip(*asked))
            order = np.argsort(h, kind="stable")
            same = h[order[1:]] == h[order[:-1]]
            many = np.zeros(len(h), bool)
            many[order[1:]] |= same
            many[order[:-1]] |= same
            found.append((ids[many], keys[many], h[many]))
        ids, keys, h = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((keys, ids))
        ids, keys, h = ids[order], keys[order], h[order]
        return _table([(b, _pack_hashes(ids[k], keys[k], h[k])) for b, k in _deal(ids, buckets)], PACKED)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches(list(batches_of(rows, schema)), schema)


def gather_hashes(group: pa.Table) -> pa.Table:
    """A row for each document: its shared hashes."""
    return _gathered([_unpack_hashes(x) for x in group.column("payload").to_pylist()])


def gather_windows(group: pa.Table) -> pa.Table:
    """A row for each document: first and number of the windows that go, in pairs."""
    parts = [_unpack(x, np.int64, np.int64, np.uint32, np.uint8) for x in group.column("payload").to_pylist()]
    return _gathered([(i, k, np.stack((f, n), 1, dtype=np.int64)) for i, k, f, n in parts])


def _gathered(parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    ids, keys, values = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((keys, ids))
    ids, keys, values = ids[order], keys[order], values[order]
    start, end = _runs(ids, keys)
    return pa.Table.from_arrays([pa.array(ids[start]), pa.array(keys[start]), pa.array([values[s:e].tobytes() for s, e in zip(start, end)], pa.binary())], schema=GATHERED)


# ---------------------------------------------------------------- stretches of text


def send_stretches(buckets: int):
    """Packed rows with the stretches of shared anchors; equal stretches of one batch leave it once, for the smallest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts, found in _texts(batches, "found"):
            data, starts, ends = _joined(texts)
            whole = data.tobytes()
            doc, h, first, count, where = anchors(data, starts, ends)
            keep = np.zeros(len(h), bool)
            lo = np.searchsorted(doc, np.arange(len(ids) + 1)).tolist()
            for k, mine in enumerate(found):
                if mine:
                    keep[lo[k] : lo[k + 1]] = np.isin(h[lo[k] : lo[k + 1]], np.frombuffer(mine, np.uint64))
            doc, h, first, count, where = (x[keep] for x in (doc, h, first, count, where))
            bucket, at = _by_bucket(h, buckets), first - starts[doc]
            seen: dict[tuple[int, bytes], int] = {}
            gone = np.zeros(len(doc), bool)
            stretches = []
            id_list = ids.tolist()
            for k, (d, f, n, w) in enumerate(zip(doc.tolist(), first.tolist(), count.tolist(), where.tolist())):
                stretches.append(x := whole[f : f + n + GRAM - 1])
                gone[k] = id_list[seen.setdefault((w - f, x), d)] < id_list[d]
            out = []
            if gone.any():
                out.append((int(ids[0] % buckets), b"\1" * 8 + _pack(ids[doc[gone]], keys[doc[gone]], at[gone].astype(np.uint32), count[gone].astype(np.uint8))))
            sent = np.flatnonzero(~gone)
            sent = sent[np.argsort(bucket[sent], kind="stable")]
            for s, e in zip(*_runs(bucket[sent])):
                k = sent[s:e]
                row, index = np.unique(doc[k], return_inverse=True)
                text = b"".join(stretches[j] for j in k.tolist())
                body = _pack(ids[row], keys[row], index.astype(np.uint32), at[k].astype(np.uint32), count[k].astype(np.uint8), (where[k] - first[k]).astype(np.uint8), np.frombuffer(text, np.uint8))
                out.append((int(bucket[k[0]]), b"\0" * 8 + zstandard.compress(body, 3)))
            yield from batches_of(out, PACKED)

    return run


# ---------------------------------------------------------------- suffix order and longest previous factors


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier entry that is smaller, -1 if there is none.

    All entries jump at once: between an entry and where it points nothing is smaller, so it may follow the pointer of an entry that isn't smaller.
    """
    at = np.arange(-1, len(values) - 1)
    todo = np.flatnonzero(at >= 0)
    while len(todo := todo[values[at[todo]] >= values[todo]]):
        at[todo] = at[at[todo]]
        todo = todo[at[todo] >= 0]
    return at


def next_smaller(values: np.ndarray) -> np.ndarray:
    back = previous_smaller(values[::-1])[::-1]
    return np.where(back < 0, -1, len(values) - 1 - back)


class Suffixes:
    """Suffix order of data's positions by their first GRAM bytes."""

    def __init__(self, data: np.ndarray, positions: np.ndarray):
        padded = np.concatenate((data, np.zeros(GRAM, np.uint8))).astype(np.uint64)
        rank, size = padded, 1
        self.ranks = {1: rank}
        while size < 32:
            pair = (rank[:-size] << np.uint64(32)) | rank[size:]
            size *= 2
            rank = pair if size <= 2 else np.unique(pair, return_inverse=True)[1].astype(np.uint64)
            if size == 2:
                rank = (padded[:-1] << np.uint64(8)) | padded[1:]
            self.ranks[size] = rank
        rest = GRAM - 32
        key = (rank[positions] << np.uint64(32)) | rank[positions + rest]
        # ranks of 32 bytes at p, then at p + 18: together the order of the first 50 bytes
        self.order = positions[np.argsort(key, kind="stable")]

    def lcp(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b, up to GRAM."""
        length = np.zeros(len(a), np.int64)
        for size in (32, 16, 8, 4, 2, 1):
            rank = self.ranks[size]
            top = len(rank) - 1
            fits = (length + size <= GRAM) & (np.maximum(a, b) + length <= top)
            same = fits & (rank[np.minimum(a + length, top)] == rank[np.minimum(b + length, top)])
            length += size * same
        return length


def longest_previous_factor(data: np.ndarray, positions: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position, the longest prefix (up to GRAM bytes) that also starts at a position of a smaller owner."""
    if not len(positions):
        return np.zeros(0, np.int64)
    suffixes = Suffixes(data, positions)
    order = suffixes.order
    place = np.argsort(positions, kind="stable")
    index = place[np.searchsorted(positions[place], order)]
    own = owner[index]
    best = np.zeros(len(order), np.int64)
    for near in (previous_smaller(own), next_smaller(own)):
        has = near >= 0
        best[has] = np.maximum(best[has], suffixes.lcp(order[has], order[near[has]]))
    out = np.empty(len(positions), np.int64)
    out[index] = best
    return out


def settle_stretches(buckets: int):
    """Packed rows: first and number of the windows that go, dealt out by the rows' ids."""

    def run(group: pa.Table) -> pa.Table:
        removed, parts = [], []
        for payload in group.column("payload").to_pylist():
            if payload[0]:
                removed.append(tuple(_unpack(payload[8:], np.int64, np.int64, np.uint32, np.uint8)))
            else:
                parts.append(_unpack(zstandard.decompress(payload[8:]), np.int64, np.int64, np.uint32, np.uint32, np.uint8, np.uint8, np.uint8))
        if parts:
            removed += _settled(parts)
        ids, keys, first, count = (np.concatenate(x) for x in zip(*removed))
        order = np.lexsort((first, keys, ids))
        ids, keys, first, count = (x[order] for x in (ids, keys, first, count))
        out = _table([(b, _pack(ids[k], keys[k], first[k], count[k])) for b, k in _deal(ids, buckets)], PACKED)
        release_memory()
        return out

    return run


def _settled(parts: list[list[np.ndarray]]) -> list[tuple[np.ndarray, ...]]:
    ids = np.concatenate([p[0][p[2]] for p in parts])
    keys = np.concatenate([p[1][p[2]] for p in parts])
    first, count, before = (np.concatenate([p[i] for p in parts]) for i in (3, 4, 5))
    data = np.concatenate([p[6] for p in parts])
    size = count.astype(np.int64) + GRAM - 1
    start = np.cumsum(size) - size
    whole = data.tobytes()
    seen: dict[tuple[int, bytes], int] = {}
    gone = np.zeros(len(ids), bool)
    id_list = ids.tolist()
    order = np.lexsort((first, keys, ids))
    for k, i, b, s, e in zip(order.tolist(), ids[order].tolist(), before[order].tolist(), start[order].tolist(), (start + size)[order].tolist()):
        gone[k] = id_list[seen.setdefault((b, whole[s:e]), k)] < i
    out = [tuple(x[gone] for x in (ids, keys, first, count))]
    del seen, whole, id_list
    left = np.flatnonzero(~gone)
    anchor = hashes_at(data, start + before, ANCHOR)
    _, inverse, times = np.unique(anchor[left], return_inverse=True, return_counts=True)
    left = left[times[inverse] > 1]
    left = left[np.argsort(anchor[left], kind="stable")]
    at = 0
    while at < len(left):  # whole anchors, about a million bytes at a time
        end = min(at + 15_000, len(left))
        while end < len(left) and anchor[left[end]] == anchor[left[end - 1]]:
            end += 1
        out.append(_factors(left[at:end], ids, keys, first, count, data, start))
        at = end
    return out


def _windows(chosen: np.ndarray, count: np.ndarray, start: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chosen stretches' bytes in a row; of each of their windows its place there, its stretch and its number in it."""
    n = count[chosen].astype(np.int64)
    size = n + GRAM - 1
    own = np.cumsum(size) - size
    text = data[np.repeat(start[chosen] - own, size) + np.arange(size.sum())]
    entry = np.repeat(np.arange(len(chosen)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return text, own[entry] + within, entry, within


def _factors(chosen: np.ndarray, ids, keys, first, count, data, start) -> tuple[np.ndarray, ...]:
    text, place, entry, within = _windows(chosen, count, start, data)
    h = string_hashes(text, GRAM)[place]
    order = np.sort(h)
    twice = np.isin(h, order[1:][order[1:] == order[:-1]])  # the others cannot match
    chosen = chosen[np.unique(entry[twice])]
    if not len(chosen):
        return tuple(x[:0] for x in (ids, keys, first, count))
    text, place, entry, within = _windows(chosen, count, start, data)
    length = longest_previous_factor(text, place, ids[chosen][entry])
    hit = length >= GRAM
    k = chosen[entry[hit]]
    return ids[k], keys[k], (first[k] + within[hit]).astype(np.uint32), np.ones(len(k), np.uint8)


# ---------------------------------------------------------------- what is left of each document


def _kept(data: bytes, windows: bytes | None, copy: bool | None) -> tuple[bytes, int, int]:
    """The remaining bytes, number of bytes and of runs removed."""
    if copy and len(data) >= GRAM:
        return b"", len(data), 1
    if not windows:
        return data, 0, 0
    pairs = np.frombuffer(windows, np.int64).reshape(-1, 2)
    depth = np.zeros(len(data) + 1, np.int32)
    np.add.at(depth, pairs[:, 0], 1)
    np.add.at(depth, pairs[:, 0] + pairs[:, 1] + GRAM - 1, -1)
    gone = np.cumsum(depth)[:-1] > 0
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


KEPT = pa.schema([("id", pa.int64()), ("row_hash", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])
KEPT_DDL = "id long, row_hash long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, k, data, windows, copy in zip(*(batch.column(c).to_pylist() for c in ("id", "row_hash", "data", "found", "copy"))):
                kept, gone, spans = _kept(data, windows, copy)
                rows.append((i, k, len(data), gone, spans, kept if with_text else None, hashlib.sha256(kept).hexdigest()))
            yield from batches_of(rows, KEPT)

    return run


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(order_id().alias("id"), F.xxhash64(order_id(), text).alias("row_hash"), text_bytes().alias("data"), *more)


def removed_windows(docs: DataFrame, *more: Column) -> tuple[DataFrame, DataFrame]:
    """The keyed documents (id, row_hash, data, more), and of those that lose something (id, row_hash, copy, found): a later copy of a whole text, or the windows that go.

    More columns travel with the documents all the way, so that a join with the result finds them in the exchange that the search made.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared_checkpoints(spark)
    key = ["id", "row_hash"]
    rows = _keyed(docs, *more)  # dealt out by key for three joins; the plans are equal, so the exchange is made once
    # the digests stand for whole texts: 256 bits of SHA-2
    long = _keyed(docs).where(F.length("data") >= GRAM)
    digests = long.select(*key, F.unhex(F.sha2("data", 256)).alias("digest"), F.length("data").alias("size")).checkpoint()
    seen = digests.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    buckets = max(shuffle_partitions(spark), -(-(seen.bytes or 0) // BUCKET_BYTES))
    lowest = digests.groupBy("digest").agg(F.min("id").alias("low"), F.count("*").alias("n")).where("n > 1")
    copies = join_groups(digests.drop("size"), lowest, "digest", seen.n).where("id > low").select(*key).distinct()
    firsts = rows.join(copies, key, "left_anti")
    shared = firsts.mapInArrow(thrifty(send_anchors(buckets)), PACKED_DDL).groupBy("bucket").applyInArrow(answer_anchors(buckets), PACKED_DDL)
    shared = shared.groupBy("bucket").applyInArrow(gather_hashes, GATHERED_DDL)
    stretches = firsts.join(shared, key).mapInArrow(thrifty(send_stretches(buckets)), PACKED_DDL)
    windows = stretches.groupBy("bucket").applyInArrow(settle_stretches(buckets), PACKED_DDL).groupBy("bucket").applyInArrow(gather_windows, GATHERED_DDL)
    lost = windows.select(*key, F.lit(False).alias("copy"), "found").unionByName(copies.select(*key, F.lit(True).alias("copy"), F.lit(None).cast("binary").alias("found")))
    return rows, lost


def dedup_passages(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """(id, row_hash, n_bytes, n_removed, n_spans, kept, kept_sha256), a row for each row of docs; kept is null without with_text."""
    rows, lost = removed_windows(docs)
    return rows.join(lost, ["id", "row_hash"], "left").mapInArrow(thrifty(_apply(with_text)), KEPT_DDL)


def query(docs: DataFrame) -> DataFrame:
    out = dedup_passages(docs, with_text=False)
    return out.select(_doc_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _doc_id():
    return F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with later copies of passages cut out of their texts; documents that lose all of it go.

    A cut inside a character drops the character's remaining bytes. Documents that lose nothing come back as they are.
    """
    rest = F.struct(F.col("text").isNull().alias("__null"), *(F.col(c) for c in docs.columns if c != "text")).alias("rest")
    rows, lost = removed_windows(docs, rest)
    cut = F.pandas_udf(_cut_texts, "string").asNondeterministic()  # else it would run once for the filter and once for the result
    changed = F.col("copy").isNotNull()
    joined = rows.join(lost, ["id", "row_hash"], "left").select(changed.alias("__changed"), F.when(changed, cut("data", "found", "copy")).otherwise(F.col("data").cast("string")).alias("__text"), "rest.*")
    out = joined.where(~F.col("__changed") | (F.trim("__text") != "")).withColumn("text", F.when(~F.col("__null"), F.col("__text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _cut_texts(data, windows, copies):
    import pandas as pd

    return pd.Series([None if c is None or c != c else _kept(bytes(d), w, c)[0].decode(errors="ignore") for d, w, c in zip(data, windows, copies)])
