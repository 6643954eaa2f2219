"""Approximate nearest neighbours by adaptive dimension scan (operator 10).

Unit vectors are rotated by a random orthogonal matrix and kept in lists, one for each
centroid. A query scans the lists of its nearest centroids. A list is scanned in blocks of columns: after
rotation the distance over the first t of d columns, times d / t, estimates the whole one, and a
candidate is abandoned once its estimate exceeds the current fifth best distance by
more than a hypothesis test allows. Survivors are scored exactly, in double precision on the
original vectors.

Centroids are fitted on a bounded sample (SAMPLE vectors, by a hash of vec_id); every vector is indexed. How many
lists a query scans is measured on the same sample, against brute force in it: few where vectors form clusters, many where they don't.
Lists are split into cells of bounded size, by candidates and by queries, so that one list with a third of
all vectors is spread over many tasks; each cell sends its best for each query.

Vectors that are null or zero or hold a null or non-finite component, rows without vec_id, and vectors of another
length than most (of equally frequent lengths, the smaller) take no part. Equal scores rank by
vec_id. Rows that repeat a query's vec_id are the query's own and no candidates; with different vectors they ask together, for the nearest to any of them.
Repeated candidates, of one vec_id and vector, come out once; a vec_id with different vectors comes out with the score of each. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import shared_checkpoints, workers_import

SAMPLE = 20_000
MAX_LISTS = 1024
#: Share of true neighbours that must lie in the scanned lists, how many of the sample's vectors measure it, and how many lists are scanned at least.
RECALL, MEASURED, LEAST_PROBED = 0.97, 400, 8
#: Rows of a cell at most, about: candidates, queries.
CELL_ROWS, CELL_QUERIES = 20_000, 2_000
BLOCK = 16
#: The hypothesis test's factor; larger values abandon fewer candidates.
EPSILON = 2.1
SCAN_ROWS = 4096
K = 5

CELL_DDL = "query_id long, vec_id long, score double"
CELL = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A row for each list of numbers; all have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(20_011).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means on unit vectors; lists without members keep their place."""
    rng = np.random.default_rng(20_021)
    c = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.sqrt((total * total).sum(axis=1))
        some = norm > 1e-9
        c[some] = total[some] / norm[some, None]
    return c


def probes_needed(sample: np.ndarray, middle: np.ndarray, recall: float = RECALL) -> int:
    """How many nearest lists hold that share of the sample's neighbours of some of its own vectors."""
    own = (sample @ middle.T).argmax(axis=1)
    ranks = []
    for q in np.linspace(0, len(sample) - 1, min(MEASURED, len(sample))).astype(int):
        near = sample @ sample[q]
        near[q] = -np.inf
        best = np.argpartition(-near, min(K, len(sample) - 1) - 1)[:K] if len(sample) > 1 else np.zeros(0, int)
        order = np.argsort(-(middle @ sample[q]), kind="stable")
        place = np.empty(len(order), int)
        place[order] = np.arange(len(order))
        ranks += place[own[best]].tolist()
    return int(np.quantile(ranks, recall, method="higher")) + 1 if ranks else 1


def scan(query: np.ndarray, vectors: np.ndarray, k: int = K) -> np.ndarray:
    """Indexes of the rotated vectors that may be among the query's k nearest, ties at the bound included."""
    n, d = vectors.shape
    kept_index, kept = np.zeros(0, np.int64), np.zeros(0)
    bound = np.inf
    for at in range(0, n, SCAN_ROWS):
        part = vectors[at : at + SCAN_ROWS]
        alive, distance = np.arange(len(part)), np.zeros(len(part))
        for t in range(0, d, BLOCK):
            piece = part[alive, t : t + BLOCK] - query[t : t + BLOCK]
            distance = distance + np.einsum("ij,ij->i", piece, piece)
            seen = min(t + BLOCK, d)
            if bound < np.inf:
                limit = bound * (1 + EPSILON / math.sqrt(seen)) ** 2 * seen / d if seen < d else bound
                stay = distance <= limit + 1e-9
                alive, distance = alive[stay], distance[stay]
            if not len(alive):
                break
        if not len(alive):
            continue
        kept_index, kept = np.concatenate((kept_index, alive + at)), np.concatenate((kept, distance))
        if len(kept) > k:
            bound = np.partition(kept, k - 1)[k - 1]
            stay = kept <= bound + 1e-9
            kept_index, kept = kept_index[stay], kept[stay]
    return kept_index


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of query and each vector; equal vectors have equal results."""
    a, b = query / np.abs(query).max(), vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (b * a).sum(axis=1) / (np.sqrt((b * b).sum(axis=1)) * np.sqrt((a * a).sum()))


def _once(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Indexes without rows that repeat another one's id and vector; ids are in order, and repeats are in one cell."""
    repeated = np.flatnonzero(ids[1:] == ids[:-1]) + 1
    seen, out = set(), np.ones(len(ids), bool)
    for k in np.union1d(repeated - 1, repeated).tolist():
        row = (int(ids[k]), vectors[k].tobytes())
        out[k] = row not in seen
        seen.add(row)
    return np.flatnonzero(out)


def _search_cell(turn: np.ndarray):
    def run(group: pa.Table) -> pa.Table:
        is_query = group.column("is_query").to_numpy()
        ids = group.column("vec_id").to_numpy()
        vectors = _matrix(group.column("embedding"))
        queries, query_ids = vectors[is_query], ids[is_query]
        order = np.argsort(ids[~is_query], kind="stable")
        rows, row_ids = vectors[~is_query][order], ids[~is_query][order]
        once = _once(row_ids, rows)
        rows, row_ids = rows[once], row_ids[once]
        found: list[tuple[np.ndarray, ...]] = []
        if len(queries) and len(rows):
            turned, turned_queries = units(rows) @ turn, units(queries) @ turn
            for q, turned_q, q_id in zip(queries, turned_queries, query_ids.tolist()):
                near = scan(turned_q, turned, K + int((np.searchsorted(row_ids, q_id, "right") - np.searchsorted(row_ids, q_id))))
                near = near[row_ids[near] != q_id]
                score = cosines(q, rows[near])
                best = np.lexsort((row_ids[near], -score))[:K]
                found.append((np.full(len(best), q_id), row_ids[near][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=CELL)

    return run


def valid_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), e).where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)).where(fine)
    usual = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("embedding") == (usual.d if usual else 0))


def search(df: DataFrame, is_query, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the K nearest found of each row for which the condition holds."""
    spark = df.sparkSession
    shared_checkpoints(spark)
    workers_import(spark)
    rows = valid_vectors(df)
    n = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    sample = units(_matrix(drawn.column("embedding")))
    turn = rotation(sample.shape[1])
    lists = max(1, min(MAX_LISTS, len(sample), int(math.sqrt(n))))
    middle = centroids(sample @ turn, lists)
    probes = min(lists, max(LEAST_PROBED, probes_needed(sample @ turn, middle, recall)))

    def assign(batches):
        for batch in batches:
            near = (units(_matrix(batch.column("embedding"))) @ turn @ middle.T).argmax(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(near.astype(np.int32))], names=["vec_id", "embedding", "list"])

    kind = rows.schema["embedding"].dataType.simpleString()
    indexed = rows.mapInArrow(assign, f"vec_id long, embedding {kind}, list int").checkpoint()
    size = {r.list: r.n for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # MAX_LISTS rows at most
    filled = np.array(sorted(size))
    counts = np.array([size[k] for k in filled.tolist()])

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = (-(units(_matrix(batch.column("embedding"))) @ turn @ middle[filled].T)).argsort(axis=1, kind="stable")
            # enough lists, and enough rows in them for K neighbours
            enough = (np.cumsum(counts[order], axis=1) < 4 * K).sum(axis=1) + 1
            chosen = [filled[o[: max(probes, e)]].tolist() for o, e in zip(order, enough.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(chosen, pa.list_(pa.int32()))], names=["vec_id", "embedding", "lists"])

    asked = indexed.where(is_query).select("vec_id", "embedding").mapInArrow(probe, f"vec_id long, embedding {kind}, lists array<int>")
    asked = asked.select("vec_id", "embedding", F.explode("lists").alias("list")).checkpoint()
    asked_size = {r.list: r.n for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}
    parts = spark.createDataFrame([(k, -(-size[k] // CELL_ROWS), -(-m // CELL_QUERIES)) for k, m in asked_size.items()], "list int, row_parts int, query_parts int")
    spread = lambda c, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    parts = F.broadcast(parts)  # MAX_LISTS rows at most
    held = indexed.join(parts, "list").select("list", "vec_id", "embedding", F.lit(False).alias("is_query"), spread("row_parts", 1).alias("row_part"), every("query_parts").alias("query_part"))
    asking = asked.join(parts, "list").select("list", "vec_id", "embedding", F.lit(True).alias("is_query"), every("row_parts").alias("row_part"), spread("query_parts", 2).alias("query_part"))
    found = held.unionAll(asking).groupBy("list", "row_part", "query_part").applyInArrow(_search_cell(turn), CELL_DDL)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def query(df: DataFrame) -> DataFrame:
    return search(df, F.col("vec_id") % 50 == 0)
