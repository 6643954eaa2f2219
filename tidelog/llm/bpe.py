"""Byte-level BPE encoding and decoding (operator 5).

A text is split by the tokenizer's pattern; each piece is merged on its own. The pieces
a batch hasn't met before are sorted into buckets by length and become rows of padded
matrices: in each round every row merges its leftmost pair of minimum rank, found
in a hash table of pairs, and the matrix is compacted by one column. Rows without a
mergeable pair leave. Pieces over LONG bytes, where rounds over a wide matrix would
cost the square of the length, are merged with a heap in the same order.

Null texts count as empty and have no tokens. Rows are independent: order, repeats and
other columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import small_batches, thrifty

LONG = 256
#: Pieces that a worker remembers; at the bound it forgets them all.
REMEMBERED = 400_000
NONE = np.int32(2**31 - 1)


#: Ranges of characters that the pattern's letters and numbers don't include, being assigned after Unicode 16, though the regex module knows them.
LATER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a "
    "11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: A character that is neither letter, number nor space.
NEITHER = "\ue000"


def later_characters() -> regex.Pattern:
    parts = [[chr(int(x, 16)) for x in part.split("-")] for part in LATER.split()]
    return regex.compile("[" + "".join("-".join(p) for p in parts) + "]")


class PairTable:
    """Open-addressing hash table from a pair of ids to the id (the rank) of what they merge into."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(left)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        keys = self._key(left, right)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = keys[todo[free]]
            placed = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[placed]]] = merged[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, NONE where a pair doesn't merge or one side is -1."""
        out = np.full(left.shape, NONE, np.int32)
        ok = (left >= 0) & (right >= 0)
        keys = self._key(left[ok], right[ok])
        slot, found, todo = self._slot(keys), np.full(len(keys), NONE, np.int32), np.arange(len(keys))
        while len(todo):
            here = self.keys[slot[todo]]
            hit = here == keys[todo]
            found[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (here != -1)]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
        out[ok] = found
        return out


class ByteBPE:
    """Encoder and decoder for a file of ranks (a base64 token and its rank on each line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a = self.ranks.get(token[:cut])
                if a is not None and (b := self.ranks.get(token[cut:])) is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(np.array(left, np.int32), np.array(right, np.int32), np.array(merged, np.int32))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern, self.later = regex.compile(pattern), later_characters()
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.later.search(text):
            return self.pattern.findall(text)
        return [text[slice(*m.span())] for m in self.pattern.finditer(self.later.sub(NEITHER, text))]

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bound = 1
        while True:
            rows = np.flatnonzero((size > bound // 2) & (size <= bound)) if bound > 1 else np.flatnonzero(size == 1)
            for at in range(0, len(rows), 32_768):
                self._merge_matrix(pieces, rows[at : at + 32_768], bound, out)
            if bound >= LONG:
                break
            bound *= 2
        for k in np.flatnonzero(size > LONG).tolist():
            out[k] = self._merge_long(pieces[k])
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        size = np.array([len(pieces[k]) for k in rows.tolist()], np.int64)
        ids = np.full((len(rows), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces[k] for k in rows.tolist()), np.uint8)]
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if rank.shape[1]:
                at = rank.argmin(axis=1)  # the leftmost of the smallest
                best = rank[np.arange(len(rows)), at]
                done = best == NONE
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                for k, row, n in zip(rows[done].tolist(), ids[done], size[done].tolist()):
                    out[k] = row[:n]
                go = ~done
                rows, ids, rank, size = rows[go], ids[go], rank[go], size[go]
                if not len(rows):
                    return
                at, best = at[go], best[go]
            n, each = ids.shape[1], np.arange(len(rows))
            ids[each, at] = best
            keep = np.ones(ids.shape, bool)
            keep[each, at + 1] = False
            ids = ids[keep].reshape(len(rows), n - 1)
            keep = np.ones(rank.shape, bool)
            keep[each, at] = False
            rank = rank[keep].reshape(len(rows), n - 2)
            size = size - 1
            has = at > 0
            rank[each[has], at[has] - 1] = self.pairs(ids[each[has], at[has] - 1], best[has])
            has = at < n - 2
            rank[each[has], at[has]] = self.pairs(best[has], ids[each[has], at[has] + 1])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges in the same order by a heap of (rank, place) over linked parts."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        end = len(parts)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= end or parts[i] + parts[j] != self.tokens[r]:
                continue
            parts[i], parts[j] = self.tokens[r], None
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
                if (s := self.ranks.get(parts[i] + parts[after[i]])) is not None:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := self.ranks.get(parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (s, h))
        return np.array([self.ranks[p] for p in parts if p is not None], np.int32)

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({w for words in split for w in words if w not in known})
        if new:
            encoded = self.merge([w.encode("utf-8", "surrogatepass") for w in new])
            known.update((w, ids.astype("<u4").tobytes()) for w, ids in zip(new, encoded))
        return [b"".join([known[w] for w in words]) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def with_column(df: DataFrame, source: str, target: str, make) -> DataFrame:
    """df with a binary column that make(list of values) gives for each batch; df's other columns stay, target replaces one of its name."""
    small_batches(df.sparkSession)
    df = df.drop(target)
    schema = T.StructType([*df.schema.fields, T.StructField(target, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(make(batch.column(source).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, target])

    return df.mapInArrow(thrifty(run), schema)


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """df with a column of ids: the text's tokens as little-endian unsigned 32-bit integers."""
    return with_column(df, column, ids, lambda texts: load(path, pattern).encode_batch(texts))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """df with the bytes that the ids stand for; null ids give no bytes."""
    return with_column(df, ids, column, lambda rows: [load(path, pattern).decode(x or b"") for x in rows])


def query(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    out = decode(encode(docs.select("doc_id", "text"), path, pattern).drop("text"), path, pattern)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
