"""Exact top-k search over vectors, by MaxScore.

The terms of a query are its components. Within a shard a term's score has a bound, the
largest product it can give there. Terms are split at the least score that still matters,
the k-th best so far: those with the smallest bounds, together below it, are
non-essential, for no vector can get into the result by them alone. The essential ones are
summed for all vectors of the shard; the others are looked up from the largest bound down,
only for vectors that can still reach the k-th best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.staging import staged
from paperloom.plans.ordering import row_positions

#: Vectors of a shard, and queries that are broadcast at a time.
SHARD = 4096
BLOCK = 16_384
#: Queries that a task scores at a time, vectors that give the first bound, and
#: non-essential terms that are looked up at a time.
TOGETHER = 256
FIRST = 512
PROBED = 8
#: Components are cut to this size, so that scores of up to 2**15 components fit 64 bits.
LARGEST = 1 << 24
NO_ID = np.iinfo(np.int64).max


def whole_numbers(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of all components; shorter vectors are filled up with zeros."""
    ends = vectors.offsets.to_numpy().astype(np.int64)
    length = np.diff(ends)
    width = int(length.max()) if len(length) else 0
    out = np.zeros((len(length), width), np.int32)
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    place = np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], length)
    out[np.repeat(np.arange(len(length)), length), place] = np.clip(flat, -LARGEST, LARGEST).astype(np.int32)
    return out


def _packed(scale: float):
    """One row per SHARD vectors: ids (null ones last among equals), width and components."""
    def emit(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        data = whole_numbers(table.column(1), scale)
        return pa.record_batch([pa.array([table.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([data.shape[1]], pa.int32()),
                                pa.array([data.tobytes()], pa.binary())], ["ids", "width", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, SHARD - size)
                held.append(part)
                size += len(part)
                batch = batch.slice(len(part))
                if size == SHARD:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)
    return run


def _matrix(data: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(rows, width)


def _queries(divisor: int):
    """Vectors of the shards whose id is divisible: (shard, place, id, data)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, ids, width, data in zip(*(batch.column(k).to_pylist() for k in ("shard", "ids", "width", "data"))):
                matrix = _matrix(data, width, len(ids))
                at = [k for k, x in enumerate(ids) if x is not None and x % divisor == 0]
                yield pa.record_batch([pa.array([shard] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array([ids[k] for k in at], pa.int64()),
                                       pa.array([matrix[k].tobytes() for k in at], pa.binary())], ["shard", "place", "query_id", "data"])
    return run


class Best:
    """The k best vectors of every query so far: score and id."""

    def __init__(self, n: int, k: int):
        self.k, self.found = k, [np.empty((0, 2), np.int64)] * n
        self.least = np.full(n, -np.inf)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:
            near = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[near], ids[near]
        rows = np.concatenate([self.found[query], np.stack([scores.astype(np.int64), ids], axis=1)])
        self.found[query] = rows = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:self.k]]
        if len(rows) == self.k:
            self.least[query] = rows[-1, 0]
            if abs(self.least[query]) > 1 << 52:  # rounded: stay below
                self.least[query] = np.nextafter(self.least[query], -np.inf)


def search_shard(queries: np.ndarray, terms: np.ndarray, ids: np.ndarray, own: np.ndarray, best: Best) -> None:
    """Let the vectors of a shard compete: `terms` has a row per component, in whole numbers
    (exact) of the type of `queries`; own[i] is the place of query i in this shard, or -1."""
    bounds = np.maximum(np.maximum(queries * terms.max(axis=1), queries * terms.min(axis=1)), 0)
    ascending = np.argsort(bounds, axis=1, kind="stable")
    upto = np.cumsum(np.take_along_axis(bounds, ascending, axis=1), axis=1)
    # Strictly below the k-th best: a vector of equal score may come first by its id.
    cut = (upto < best.least[:, None]).sum(axis=1)
    rest = np.where(cut > 0, np.take_along_axis(upto, np.maximum(cut - 1, 0)[:, None], axis=1)[:, 0], 0)
    rank = np.empty_like(ascending)
    np.put_along_axis(rank, ascending, np.arange(bounds.shape[1])[None, :], axis=1)
    scored = np.where(rank >= cut[:, None], queries, 0).astype(queries.dtype) @ terms
    alive = scored + rest[:, None] >= best.least[:, None]
    for i in range(len(queries)):
        at = np.flatnonzero(alive[i])
        if own[i] >= 0:
            at = at[at != own[i]]
        score, left = scored[i, at], rest[i]
        for k in range(int(cut[i]), 0, -PROBED):
            if not len(at):
                break
            some = ascending[i, max(k - PROBED, 0):k]
            score = score + queries[i, some] @ terms[np.ix_(some, at)]
            left = left - bounds[i, some].sum()
            keep = score + left >= best.least[i]
            at, score = at[keep], score[keep]
        if len(at):
            best.add(i, score, ids[at])


def _exact_type(queries: np.ndarray, terms: np.ndarray) -> type:
    """The smallest type that holds every sum of products exactly."""
    most = float(np.abs(queries).sum(axis=1, dtype=np.float64).max(initial=0)) * float(np.abs(terms).max(initial=0))
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def _search(shared: Broadcast, k: int):
    """The k best of a task's shards for every query of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, query_ids, shards, places, vectors = shared.value
        best = [Best(min(TOGETHER, len(at) - a), k) for a in range(0, len(at), TOGETHER)]
        for batch in batches:
            for shard, ids, width, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "ids", "width", "data"))):
                matrix = _matrix(data, width, len(ids))
                ids = np.array([NO_ID if x is None else x for x in ids], np.int64)
                both = min(width, vectors.shape[1])  # what only one side has counts as zero
                for part, a in zip(best, range(0, len(at), TOGETHER)):
                    mine = slice(a, a + TOGETHER)
                    own = np.where(shards[mine] == shard, places[mine], -1)
                    first = min(FIRST, len(ids)) if np.isinf(part.least).any() else 0
                    for low, high in ((0, first), (first, len(ids))):
                        if low == high:
                            continue
                        queries, terms = vectors[mine, :both], matrix[low:high, :both].T
                        if not both:  # vectors without components: all products are zero
                            queries, terms = np.zeros((len(queries), 1), np.int32), np.zeros((1, high - low), np.int32)
                        kind = _exact_type(queries, terms)
                        search_shard(queries.astype(kind), np.ascontiguousarray(terms, kind), ids[low:high],
                                     np.where((own >= low) & (own < high), own - low, -1), part)
        for part, a in zip(best, range(0, len(at), TOGETHER)):
            rows = [(at[a + i], query_ids[a + i], r[1], r[0]) for i, found in enumerate(part.found) for r in found]
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.record_batch([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], mask=columns[2] == NO_ID), pa.array(columns[3])],
                                  ["at", "query_id", "vec_id", "score"])
    return run


def _broadcast(block: DataFrame) -> Broadcast:
    """A block of queries as arrays: BLOCK vectors at most."""
    rows = block.orderBy("at").toArrow().combine_chunks()
    raw = [np.frombuffer(x, np.int32) for x in rows.column("data").to_pylist()]
    vectors = np.zeros((len(raw), max(map(len, raw), default=0)), np.int32)
    for i, x in enumerate(raw):
        vectors[i, :len(x)] = x
    whole = [rows.column(c).to_numpy() for c in ("at", "query_id", "shard", "place")]
    return block.sparkSession.sparkContext.broadcast((*whole, vectors))


def top_k(
    vectors: DataFrame, k: int = 5, divisor: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k vectors with the largest inner product with
    every query, ties to the smaller id. Queries are the rows whose id is divisible by
    `divisor`, candidates all rows but the query's own.

    Components are floor(scale * x). Vectors that are null or hold null or non-finite
    components take no part. Of vectors of different lengths the common components count;
    components beyond LARGEST after scaling count as LARGEST. Rows with one id are vectors
    of their own, and queries of their own; a null id is never a query and comes last among
    equal scores. Fewer candidates than k are all returned; an empty table gives no rows.
    Other columns are ignored.

    Vectors lie in shards of SHARD rows, one row each. BLOCK queries at a time are
    broadcast and meet all shards in place, so neither side is replicated by a shuffle. A
    task keeps k vectors per query, which are merged; thresholds pass from shard to shard.
    """
    spark = vectors.sparkSession
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(vector_col).isNotNull() & sound).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    packed = rows.repartition(max(1, -(-rows.count() // SHARD))).mapInArrow(_packed(scale), "ids array<long>, width int, data binary")
    shards = staged(packed.withColumn("shard", F.monotonically_increasing_id()), "shards")
    asked = shards.mapInArrow(_queries(divisor), "shard long, place long, query_id long, data binary").withColumn("all", F.lit(0))
    asked = staged(row_positions(asked, ["all"], ["shard", "place"], "at"), "queries")
    order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for first in range(0, asked.count(), BLOCK):
        shared = _broadcast(asked.where(F.col("at").between(first, first + BLOCK - 1)))
        found = shards.mapInArrow(_search(shared, k), "at long, query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        result = result.unionByName(staged(ranked.select("query_id", "rank", "vec_id", "score"), "found"))
        shared.destroy()
    return result
