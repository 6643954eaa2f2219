"""Packing documents into sequences of bounded length (operator 8).

The documents of a partition, in their order, are one line of tokens, each document
ended by an end token. Windows of at most CAP tokens cut that line. Dynamic
programming over the places where a cut may stand (document ends, sentence ends,
and places inside sentences that are too long) minimises

    padding of each window + penalty of each cut + a fixed cost of each window.

Padding is linear in the window's start, so the best start of a window that ends at a
place is the minimum of f(start) + start over the places within CAP before it: a
sliding minimum, kept in a monotone queue. Windows whose length is a power of two
need no padding and are tried besides. The line is planned some million tokens at a
time; the last window of one plan is carried into the next, so that only a
partition's last window ends early; that one is cut into powers of two if it is far from full, and the
rest of less than SHORTEST tokens is padded.

Small partitions are joined, and else taken as they come: nothing is shuffled, and memory is bounded by the plan's
size plus the longest document. Null texts count as empty: their end token alone is packed.
Repeated rows are packed each. An empty table gives no pieces. Other columns don't matter.
"""

from __future__ import annotations

import functools
import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import small_batches, thrifty

CAP = 2048
PLAN_TOKENS = 2_000_000
#: In tokens of padding: a cut at a sentence end, a cut inside a sentence, any window.
SENTENCE_CUT, INNER_CUT, WINDOW_COST = 8.0, 64.0, 16.0
#: Stretches longer than this without a place to cut get places inside, this far apart.
INNER_STEP = 512
POWERS = [256, 512, 1024]
#: A partition's last window that would need more padding than this is cut into powers of two from the shortest on, which need none, and a rest.
TAIL_PADDING, SHORTEST = 256, 128
#: Partitions are joined, where they lie, until they hold so many bytes each by the plan's estimate: each has a rest.
PARTITION_BYTES = 2 << 20

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary file: printable bytes are themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class Encoder:
    """A byte-level BPE vocabulary file's ids; strings that the file adds as tokens have their ids, wherever they are, as its library gives them by default."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(symbol[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.sentence_end = np.zeros(max(ranks.values()) + 2, bool)
        self.sentence_end[[i for token, i in ranks.items() if token.rstrip(b" \"')")[-1:] in (b".", b"!", b"?", b"\n")]] = True

    def __call__(self, text: str | None) -> np.ndarray:
        return self.encoding.encode_to_numpy(text or "", allowed_special="all").astype("<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def places(line: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where cuts may stand, from 0 to the line's length, and what each costs."""
    ends = np.flatnonzero(sentence_end[np.minimum(line, len(sentence_end) - 1)]) + 1
    at = np.unique(np.concatenate(([0], ends, doc_ends)))
    cost = np.full(len(at), SENTENCE_CUT)
    cost[np.searchsorted(at, doc_ends)] = 0
    cost[0] = 0
    gap = np.diff(at)
    if len(wide := np.flatnonzero(gap > INNER_STEP)):
        inner = np.concatenate([np.arange(at[k] + INNER_STEP, at[k + 1], INNER_STEP) for k in wide.tolist()])
        both = np.concatenate((at, inner))
        order = np.argsort(both, kind="stable")
        at, cost = both[order], np.concatenate((cost, np.full(len(inner), INNER_CUT)))[order]
    return at, cost


def best_cuts(at: np.ndarray, cost: np.ndarray, cap: int = CAP) -> list[int]:
    """The indexes into at where windows start or end, 0 and the last included; neighbours in at are within cap."""
    exact: dict[int, list[int]] = {}
    for p in POWERS:
        k = np.searchsorted(at, at - p)
        hit = (at >= p) & (at[np.minimum(k, len(at) - 1)] == at - p)
        for j in np.flatnonzero(hit).tolist():
            exact.setdefault(j, []).append(int(k[j]))
    where, price = at.tolist(), cost.tolist()
    total, key, back = [0.0] * len(where), [0.0] * len(where), [0] * len(where)
    queue: deque[int] = deque([0])
    for j in range(1, len(where)):
        x = where[j]
        while where[queue[0]] < x - cap:
            queue.popleft()
        i = queue[0]
        best = key[i] + cap - x
        if j in exact:
            for h in exact[j]:
                if total[h] < best:
                    best, i = total[h], h
        total[j] = best = best + price[j] + WINDOW_COST
        back[j] = i
        value = key[j] = best + x
        while queue and key[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    cuts = [len(where) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def whole_tail(cuts: np.ndarray) -> np.ndarray:
    """cuts with the last window split at its binary digits, largest first, if it is far from full; what is below SHORTEST stays together."""
    size = int(cuts[-1] - cuts[-2])
    if CAP - size <= TAIL_PADDING:
        return cuts
    parts = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1 and 1 << k >= SHORTEST]
    parts += [size - sum(parts)] if size > sum(parts) else []
    return np.concatenate((cuts[:-1], cuts[-2] + np.cumsum(parts)))


class Packer:
    """Packs one partition's documents in their order."""

    def __init__(self, partition: int, sentence_end: np.ndarray):
        self.next_id = partition << 32
        self.sentence_end = sentence_end
        #: Documents in the line: id, ids, tokens of it that were packed before.
        self.docs: list[tuple[int | None, np.ndarray, int]] = []
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.waiting += len(ids)
        if self.waiting >= PLAN_TOKENS:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        line = np.concatenate([ids[done:] for _, ids, done in self.docs])
        ends = np.cumsum([len(ids) - done for _, ids, done in self.docs])
        at, cost = places(line, ends, self.sentence_end)
        cuts = at[best_cuts(at, cost)]
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]
        elif last:
            cuts = whole_tail(cuts)
        stop = int(cuts[-1])
        bounds = np.unique(np.concatenate((cuts, ends[ends < stop])))
        doc = np.searchsorted(ends, bounds[:-1], side="right").tolist()
        window = (np.searchsorted(cuts, bounds[:-1], side="right") - 1).tolist()
        for s, e, d, w in zip(bounds[:-1].tolist(), bounds[1:].tolist(), doc, window):
            doc_id, ids, done = self.docs[d]
            begin = int(ends[d]) - len(ids) + done  # where the waiting part stands in the line
            yield doc_id, s - begin + done, e - s, line[s:e].tobytes(), len(ids), self.next_id + w, s - int(cuts[w])
        self.next_id += len(cuts) - 1
        left = int(np.searchsorted(ends, stop, side="right"))
        self.docs = [(i, ids, done + max(0, stop - (int(ends[left + k]) - len(ids) + done))) for k, (i, ids, done) in enumerate(self.docs[left:])]
        self.waiting = len(line) - stop


def pack(docs: DataFrame, path: str, pattern: str, end_token: int = 1) -> DataFrame:
    """A row for each piece: its document, where it starts there, its ids (little-endian, 32 bits), its sequence and place there."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern)
        packer = Packer(TaskContext.get().partitionId(), encode.sentence_end)
        end = np.array([end_token], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows.extend(packer.add(doc_id, np.concatenate((encode(text), end))))
            if rows:
                yield _pieces(rows)
        if rows := list(packer.flush(last=True)):
            yield _pieces(rows)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _large_partitions(rows).mapInArrow(thrifty(run), PIECES_DDL)


def _large_partitions(rows: DataFrame) -> DataFrame:
    """rows with small partitions joined, without a shuffle; an estimate from file sizes is enough for that."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.coalesce(max(1, -(-size // PARTITION_BYTES))) if size < 1 << 60 else rows


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)


def query(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    out = pack(docs, path, pattern)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
