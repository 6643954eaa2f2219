"""SimHash near-duplicates (operator 6).

A document's fingerprint has a bit set where over half of its word shingles' hashes
have it set. Fingerprints within RADIUS differing bits are linked, and the classes are the
connected components.

Fingerprints are embedded as the bit counts of SEGMENTS equal parts. The Manhattan
distance of two such vectors is at most the Hamming distance, and on an integer grid
vectors within distance 2 share a grid point within distance 1 of both. So each
distinct fingerprint goes to its own grid point and its 2 * SEGMENTS neighbours; those
that meet in a point are verified on all bits. Points with few fingerprints are
compared in pairs. In a crowded point that would cost the square of the crowd;
there, fingerprints go to the 64-bit strings within one bit of them that lie in the point's
cell, and all that share one such string, which are exactly those within two bits,
are linked to the smallest of them: the same components, in proportion to the crowd.

Copies share a fingerprint and are counted once, by a combinable minimum. Null texts count as empty;
texts without words have fingerprint zero. A null doc_id counts as larger than any other
and comes back null. Rows of one doc_id have one row each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import NULL_ID, join_groups, order_id, shared_checkpoints, shuffle_partitions, small_batches, text_bytes, thrifty
from tidelog.llm.graph import components

RADIUS = 2
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
#: Grid points with more fingerprints than this link them through shared strings.
CROWD = 48
SEED = 42

PRINTS = pa.schema([("id", pa.int64()), ("print", pa.int64())])
_LOW_BITS = np.uint64(0x0101010101010101)


def shingle_hashes(data: bytes, words: int) -> list[int]:
    """Hashes of the lower-cased text's word shingles; one of all words if they are fewer."""
    parts = data.lower().split()
    if not parts:
        return []
    if len(parts) < words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    return list(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(parts[k:] for k in range(words)))), repeat(SEED)))


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each group (from its start to the next one's) have each bit; every group has some.

    Eight bits, one of each byte, are added at once; groups are cut so that no byte overflows.
    """
    ends = np.append(starts[1:], len(hashes))
    pieces = (ends - starts + 254) // 255
    owner = np.repeat(np.arange(len(starts)), pieces)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = starts[owner] + 255 * within
    first = np.cumsum(pieces) - pieces
    out = np.empty((len(starts), 64), np.int64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & _LOW_BITS, cut)
        counts = sums.astype("<u8").view(np.uint8).reshape(-1, 8)
        out[:, k::8] = np.add.reduceat(counts.astype(np.int64), first, axis=0)
    return out


def fingerprints(texts: list[bytes], words: int) -> np.ndarray:
    """Fingerprint of each text, unsigned."""
    return majorities([np.array(shingle_hashes(t, words), np.uint64) for t in texts])


def majorities(hashed: list[np.ndarray]) -> np.ndarray:
    """Of each array of hashes the bits that over half of them have; zero if it is empty."""
    size = np.array([len(h) for h in hashed], np.int64)
    out = np.zeros(len(hashed), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        counts = bit_counts(np.concatenate(hashed), (np.cumsum(size) - size)[some])
        over = 2 * counts > size[some, None]
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_prints(docs: DataFrame, words: int) -> DataFrame:
    """(id, print): each row's id and fingerprint, as a signed number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fingerprints(batch.column("data").to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made)], schema=PRINTS)

    return docs.select(order_id().alias("id"), text_bytes().alias("data")).mapInArrow(thrifty(run), "id long, print long")


def grid_point(fingerprint: Column) -> Column:
    """A fingerprint's segment counts as digits of one number; digits have room for the neighbours of 0 and of a full segment."""
    counts = [F.bit_count(F.shiftrightunsigned(fingerprint, SEGMENT_BITS * k).bitwiseAND((1 << SEGMENT_BITS) - 1)).cast("long") + 1 for k in range(SEGMENTS)]
    return sum((c * F.lit(u) for c, u in zip(counts, _digits())), F.lit(0).cast("long"))


def _digits() -> list[int]:
    return [(SEGMENT_BITS + 3) ** k for k in range(SEGMENTS)]


def near_points(point: Column) -> Column:
    """A point and those within distance 1."""
    return F.array(point, *(point + F.lit(u) for u in _digits()), *(point - F.lit(u) for u in _digits()))


def links(prints: DataFrame) -> DataFrame:
    """(a, b): edges among distinct fingerprints (column print) whose components are those of all pairs within RADIUS bits."""
    spread = prints.select("print").repartition(shuffle_partitions(prints.sparkSession), "print")  # each row becomes many
    points = spread.withColumn("centre", grid_point(F.col("print"))).select("print", F.explode(near_points(F.col("centre"))).alias("point"))
    met = points.withColumn("n", F.count("*").over(Window.partitionBy("point"))).where("n > 1").checkpoint()
    few = met.where(F.col("n") <= CROWD)
    pairs = few.select("point", F.col("print").alias("a")).join(few.select("point", F.col("print").alias("b")), "point")
    near = pairs.where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b")
    ring = F.array(F.col("print"), *(F.col("print").bitwiseXOR(F.lit(v)) for v in np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64)).view(np.int64).tolist()))
    strings = met.where(F.col("n") > CROWD).select("print").distinct().select("print", F.explode(ring).alias("string"))
    hubs = strings.groupBy("string").agg(F.min("print").alias("b"), F.count("*").alias("n")).where("n > 1").select("string", "b")
    stars = strings.join(hubs, "string").where("print <> b").select(F.col("print").alias("a"), "b")
    return near.union(stars).distinct()


def classes(docs: DataFrame, words: int = 5) -> DataFrame:
    """(id, print, component): a row for each row of docs; component is the smallest id of its class."""
    shared_checkpoints(docs.sparkSession)
    rows = with_prints(docs, words).checkpoint()
    distinct = rows.groupBy("print").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    found = components(links(distinct.select("print")))
    named = found.join(distinct, F.col("node") == F.col("print")).select("print", "component", "low")
    smallest = named.groupBy("component").agg(F.min("low").alias("smallest"))
    moved = named.join(smallest, "component").select("print", "smallest")
    label = distinct.join(moved, "print", "left").select("print", F.coalesce("smallest", "low").alias("component"), "n").checkpoint()
    return join_groups(rows, label, "print", rows.count()).select("id", "print", "component")


def query(docs: DataFrame) -> DataFrame:
    """Three-word shingles and the link rule of the query's contract."""
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return classes(docs, words=3).select(known("id").alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), known("component").alias("component_id"))


# ---------------------------------------------------------------- documents of a given similarity

SIMILARITY = 0.8
#: Samples of each document, shingles of each, and how many documents before it in a sample's order one is compared with at first.
VIEWS, VIEW_SHINGLES, NEIGHBOURS = 16, 4, 5
#: Where more share a sample, blocks of this many are compared in full; shingles that are counted at once.
BLOCK, COLUMNS = 256, 4096
_VIEW_MULTIPLIERS = np.random.default_rng(6151).integers(0, 2**64, VIEWS, dtype=np.uint64) | np.uint64(1)
VERIFIED = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def view_prints(shingles: np.ndarray) -> np.ndarray:
    """Fingerprints of VIEWS samples of a set of shingle hashes, each of the VIEW_SHINGLES that one ordering puts first."""
    order = shingles[None, :] * _VIEW_MULTIPLIERS[:, None]
    order ^= order >> np.uint64(32)
    k = min(VIEW_SHINGLES, len(shingles))
    chosen = np.argpartition(order, k - 1, axis=1)[:, :k] if len(shingles) > k else np.broadcast_to(np.arange(k), (VIEWS, k))
    counts = bit_counts(np.ascontiguousarray(shingles[chosen]).ravel(), np.arange(VIEWS) * k)
    return np.packbits(2 * counts > k, axis=1, bitorder="little").view("<u8").ravel()


def _shingle_set(data: bytes, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(data, words), np.uint64))


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(id, row_hash, node, n, print, views): node stands for the set of shingles, of which there are n; print is the whole text's fingerprint."""
    names = ["id", "row_hash", "node", "n", "print", "views"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = [np.array(shingle_hashes(x, words), np.uint64) for x in batch.column("data").to_pylist()]
            prints, sets = majorities(hashed).view(np.int64), [np.unique(h) for h in hashed]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            views = [view_prints(s).view(np.int64).tolist() if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row_hash"), pa.array(node), pa.array([len(s) for s in sets], pa.int32()), pa.array(prints), pa.array(views, pa.list_(pa.int64()))], names=names)

    return _keyed(docs).mapInArrow(thrifty(run), "id long, row_hash long, node long, n int, print long, views array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(order_id().alias("id"), F.xxhash64(order_id(), F.col("text").cast("string")).alias("row_hash"), text_bytes().alias("data"))


def _sets(nodes: DataFrame, docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of nodes; one document of each is read for its set."""
    owners = rows.join(nodes, "node").groupBy("node").agg(F.min(F.struct("id", "row_hash")).alias("o")).select("node", "o.id", "o.row_hash")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_shingle_set(x, words).tobytes() for x in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], names=["node", "shingles"])

    return _keyed(docs).join(owners, ["id", "row_hash"]).dropDuplicates(["node"]).select("node", "data").mapInArrow(thrifty(sets), "node long, shingles binary")


def _verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Pairs of nodes (a, b) whose sets of shingles have that similarity."""
    texts = _sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), docs, rows, words)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda c, s: texts.select(F.col("node").alias(c), F.col("shingles").alias(s))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(thrifty(check), "a long, b long")


def near_classes(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first one that it reaches by pairs of that similarity; all pairs are compared."""
    size = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, common = np.repeat(np.arange(len(sets)), size), count[column] > 1
    renumbered = np.cumsum(count > 1) - 1
    owner, column = owner[common], renumbered[column[common]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers, exact to 2**24
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        here = slice(*np.searchsorted(column, (low, low + COLUMNS)))
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[here], column[here] - low] = 1
        both += has @ has.T
    shared = both.astype(np.int64)
    near = shared >= similarity * (size[:, None] + size[None, :] - shared)
    first = np.full(len(sets), -1)
    for k in range(len(sets)):
        reached = np.array([k]) if first[k] < 0 else np.array([], np.int64)
        while len(reached):
            first[reached] = k
            reached = np.flatnonzero(near[reached].any(axis=0) & (first < 0))
    return first


def _crowds(views: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """(cell, node): nodes to compare with all others of their cell, so that all pairs meet that share a sample, may have that similarity and aren't connected in found (node, component).

    Only samples that more than NEIGHBOURS + 1 share and that hold several components are left. Their members are
    dealt out by size, in classes so wide that similar sets are in one class or neighbouring ones, and a class is met by the one
    below it. What is larger than BLOCK is cut into blocks, each pair of which is a cell. A component of
    more than BLOCK members has blocks of its own, which meet those of the others alone.
    """
    bin_ = ["view", "print"]
    width = 1.001 * max(-math.log(similarity), 0.01)
    labelled = views.select("node", "n", *bin_).join(found, "node", "left").select("node", "n", *bin_, F.coalesce("component", "node").alias("label"))
    mixed = labelled.groupBy(*bin_).agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.where((F.col("members") > NEIGHBOURS + 1) & (F.col("low") < F.col("high"))).select(*bin_)
    group = [*bin_, "sizes"]
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")
    members = labelled.join(mixed, bin_).select("node", "label", *bin_, F.posexplode(F.array(own, own + 1)).alias("above", "sizes")).checkpoint()
    parts = members.groupBy(*group, "label").agg(F.count("*").alias("members"), F.min("above").alias("above"))
    groups = parts.groupBy(*group).agg(F.sum("members").alias("members"), F.max(F.struct("members", "label")).alias("top"), F.count("*").alias("labels"), F.min("above").alias("above"))
    groups = groups.where("labels > 1 AND above = 0")  # the class itself has members, not just the one below it
    large = F.when(F.col("top.members") > BLOCK, F.col("top.members")).otherwise(F.lit(0))
    blocks = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
    groups = groups.select(*group, F.when(large > 0, F.col("top.label")).alias("top"), blocks(large).alias("tops"), blocks(F.col("members") - large).alias("others"))
    dealt = members.join(groups, group).withColumn("apart", F.coalesce(F.col("label") == F.col("top"), F.lit(False)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "view"), F.when(F.col("apart"), F.col("tops")).otherwise(F.col("others")).cast("long")).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    block = F.col("block")
    meet = F.transform(upto(F.col("others")), lambda k: F.struct(F.lit(0).alias("kind"), F.least(block, k).alias("i"), F.greatest(block, k).alias("j")))
    with_top = F.transform(upto(F.col("tops")), lambda k: F.struct(F.lit(1).alias("kind"), block.alias("i"), k.alias("j")))
    as_top = F.transform(upto(F.col("others")), lambda k: F.struct(F.lit(1).alias("kind"), k.alias("i"), block.alias("j")))
    cells = F.when(F.col("apart"), as_top).otherwise(F.concat(meet, with_top))
    return dealt.select("node", *group, F.explode(cells).alias("at")).select(F.struct(*group, "at").alias("cell"), "node")


def _crowd_links(cells: DataFrame, docs: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): links of nodes that meet in a cell; their components are those of all its pairs of that similarity."""
    texts = _sets(cells.select("node").distinct(), docs, rows, words)

    def compare(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        first = near_classes([np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()], similarity)
        linked = np.flatnonzero(first != np.arange(len(nodes)))
        return pa.Table.from_arrays([pa.array(nodes[linked]), pa.array(nodes[first[linked]])], schema=VERIFIED)

    return cells.join(texts, "node").groupBy("cell").applyInArrow(compare, "a long, b long")


def _grid_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): nodes whose whole texts' fingerprints are linked in the grid, within RADIUS bits, or are the same."""
    prints = rows.select("node", "print").distinct()
    firsts = prints.groupBy("print").agg(F.min("node").alias("first")).checkpoint()
    same = prints.join(firsts, "print").select(F.col("node").alias("a"), F.col("first").alias("b"))
    end = lambda c: firsts.select(F.col("print").alias(f"print_{c}"), F.col("first").alias(c))
    near = links(firsts.select("print")).withColumnsRenamed({"a": "print_a", "b": "print_b"})
    pairs = near.join(end("a"), "print_a").join(end("b"), "print_b").select("a", "b").union(same)
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _sample_pairs(views: DataFrame, similarity: float) -> DataFrame:
    """(a, b): nodes that share a sample and are next to each other in its order, by sizes that such a similarity allows."""
    views = views.withColumn("point", grid_point(F.col("print")))
    order = Window.partitionBy("view", "point").orderBy("print", "next1", "next2", "node")
    met = views.withColumn("before", F.collect_list(F.struct("node", "n", "print")).over(order.rowsBetween(-NEIGHBOURS, -1))).where(F.size("before") > 0)
    pairs = met.select(F.col("node").alias("a"), "n", "print", F.explode("before").alias("o")).where(F.col("print") == F.col("o.print"))
    pairs = pairs.where((F.least("n", "o.n") >= similarity * F.greatest("n", "o.n")))
    return pairs.select(F.least("a", "o.node").alias("a"), F.greatest("a", "o.node").alias("b"))


def similar(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """(id, row_hash, component): classes of documents whose sets of word shingles have that Jaccard similarity, directly or through others.

    Whole texts' fingerprints are linked in the grid as in classes(), and an exact check of all shingles follows.
    At a similarity of 0.8 they differ in some ten of 64 bits, though, which bit counts of segments can't tell
    from chance. So fingerprints are also taken of samples: a sample of four shingles is the same in two such documents
    two times in five, and in one of sixteen samples all but surely (2 in 10,000 pairs are missed). Samples' fingerprints
    meet in grid points, at radius 0, and these candidates are verified with the others.
    In a point's order by this and the following samples, each document is compared with the NEIGHBOURS before it: with
    all where a few meet, with the likest where many do. That joins most of what is alike; where many meet, all pairs
    that it didn't connect are compared after that, so every pair that shares a sample is verified or connected by others.
    """
    shared_checkpoints(docs.sparkSession)
    rows = _sketches(docs, words).checkpoint()
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("views").alias("views"))
    following = [F.get("views", F.pmod(F.col("view") + k, F.lit(VIEWS))) for k in (1, 2)]
    views = nodes.select("node", "n", "views", F.posexplode("views").alias("view", "print")).select("node", "n", "view", "print", following[0].alias("next1"), following[1].alias("next2"))
    pairs = _grid_pairs(rows).union(_sample_pairs(views, similarity)).distinct().checkpoint()
    found = components(_verified(pairs, docs, rows, words, similarity))
    cells = _crowds(views, found, similarity).checkpoint()
    more = _crowd_links(cells, docs, rows, words, similarity).checkpoint()
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return rows.join(found, "node", "left").select("id", "row_hash", F.coalesce("component", "node").alias("component"))


def keep_firsts(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each class of similar documents: that of the smallest doc_id."""
    firsts = similar(docs, words, similarity).groupBy("component").agg(F.min(F.struct("id", "row_hash")).alias("o"))
    firsts = firsts.select(F.col("o.id").alias("__id"), F.col("o.row_hash").alias("__hash"))
    keyed = docs.withColumn("__id", order_id()).withColumn("__hash", F.xxhash64(order_id(), F.col("text").cast("string")))
    return keyed.join(firsts, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"]).select(*docs.columns)
