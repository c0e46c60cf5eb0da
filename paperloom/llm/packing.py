"""Packing of documents into token sequences of fixed capacity.

Pieces are dealt out to partitions, and each runs best-fit decreasing. Dual feasible
functions of the piece lengths give a lower bound: a partition that meets its bound is
certified, no packing of its pieces has fewer sequences. Partitions with a gap release
their unfilled sequences, certified ones only their emptiest, and the released pieces are
dealt anew and packed again, until the bound of all pieces together is met or a round
gains nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import staged
from paperloom.llm.tokens import encoder

CAPACITY = 2048
END = 0
#: Pieces that one task packs at a time.
PARTITION = 50_000
ROUNDS = 6
#: The dual feasible functions u_k that are tried besides all f_epsilon.
STEPS = range(2, 21)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Least number of sequences that pieces of these lengths can need.

    A dual feasible function changes lengths so that what fits into one sequence still
    does, so the sum of changed lengths bounds from below. f_epsilon counts pieces longer
    than capacity - epsilon as whole sequences and drops those shorter than epsilon; u_k
    rounds lengths to multiples of 1 / k.
    """
    c = np.zeros(capacity + 1, np.int64)
    np.add.at(c, np.asarray(lengths, np.int64), np.asarray(counts, np.int64))
    size = np.arange(capacity + 1)
    above = np.concatenate([np.cumsum(c[::-1])[::-1], [0]])  # pieces of at least this length
    weight = np.concatenate([[0], np.cumsum(c * size)])
    eps = np.arange(capacity // 2 + 1)
    middle = weight[capacity - eps + 1] - weight[eps]
    best = int((above[capacity - eps + 1] + -(-middle // capacity)).max())
    for k in STEPS:
        steps = (k + 1) * size
        units = np.where(steps % capacity == 0, size * k, steps // capacity * capacity)
        best = max(best, -(-int((c * units).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, in order of descending length, and the free space of
    every bin. A bit set of the free spaces in use finds the fullest bin that fits."""
    bins, offsets, free = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0
    for i, n in enumerate(lengths.tolist()):
        fits = open_ >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = at[space].pop()
            if not at[space]:
                open_ ^= 1 << space
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        free[b] = space - n
        if free[b]:
            if not at[free[b]]:
                open_ |= 1 << free[b]
            at[free[b]].append(b)
    return bins, offsets, np.array(free, np.int64)


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as encode:
            for batch in batches:
                rows, out = [], []
                for row, text in enumerate(batch.column(1)):
                    ids = np.append(encode(text.as_py()), np.uint32(end)).astype("<u4", copy=False)
                    for k, (start, n) in enumerate(cut(len(ids), capacity)):
                        part = ids[start:start + n]
                        rows.append(row)
                        out.append((k, start, n, zlib.crc32(part), *([part.astype(np.int32)] if with_ids else [])))
                    if len(out) >= 5_000 or row == len(batch) - 1:
                        owners = batch.column(0).take(pa.array(rows, pa.int64())).cast(pa.int64())
                        yield pa.record_batch([owners, *map(pa.array, zip(*out))], names)
                        rows, out = [], []
    return run


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the token ids of every text, with
    the end id behind them, cut into pieces of at most `capacity`."""
    schema = "doc_id long, piece long, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(_pieces(tokenizer, capacity, end, with_ids), schema).withColumn("piece", F.col("piece").cast("int"))


PACKED = "at long, length long, part long, bin long, offset long, keep boolean, first boolean"


def _packer(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        length = table.column("length").to_numpy()
        order = np.lexsort((at, -length))
        length = length[order]
        bins, offsets, free = best_fit_decreasing(length, capacity)
        bound = lower_bound(*np.unique(length, return_counts=True), capacity)
        released = free > 0 if len(free) > bound else np.arange(len(free)) == free.argmax()
        return pa.table({
            "at": at[order], "length": length, "part": np.full(len(at), table.column("part")[0].as_py(), np.int64),
            "bin": bins, "offset": offsets, "keep": ~released[bins], "first": offsets == 0})
    return pack


def _round(left: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    dealt = left.withColumn("part", F.pmod(F.xxhash64("at", F.lit(salt)), F.lit(parts)))
    return staged(dealt.select("at", "length", "part").groupBy("part").applyInArrow(_packer(capacity), PACKED), "packed")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents, each with its sequence_id and its offset there.

    Pieces of a sequence follow each other without gaps from 0. A piece of full length is a
    sequence of its own. Null and empty texts are just the end id. Every row of `docs` is a
    document, repeated and null ids included. Other columns are ignored; an empty table
    gives no pieces. With `with_ids` the token ids come along, for `assemble`.
    """
    cut_up = pieces(docs, tokenizer, capacity, end, with_ids, id_col, text_col)
    cut_up = staged(cut_up.withColumn("at", F.monotonically_increasing_id()), "pieces")
    left = cut_up.where(F.col("length") < capacity).select("at", "length")
    sizes = left.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toPandas()  # one row per length
    bound = lower_bound(sizes["length"].to_numpy(), sizes["n"].to_numpy(), capacity)

    def placed(packed: DataFrame, number: int) -> DataFrame:
        sequence = F.shiftleft(F.lit(number + 1).cast("long"), 56) + F.shiftleft("part", 24) + F.col("bin")
        return packed.select("at", sequence.alias("sequence_id"), "offset")

    final: list[DataFrame] = []
    kept, best, result = 0, None, []
    for number in range(ROUNDS):
        parts = max(1, -(-left.count() // PARTITION))
        packed = _round(left, parts, number, capacity)
        total = kept + packed.where("first").count()
        if best is None or total < best:
            best, result = total, [*final, placed(packed, number)]
        elif total > best:
            break
        if total <= bound or parts == 1:
            break
        final.append(placed(packed.where("keep"), number))
        kept += packed.where("first and keep").count()
        left = packed.where("not keep").select("at", "length")
    whole = cut_up.where(F.col("length") == capacity).select("at", F.col("at").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for more in result:
        whole = whole.unionByName(more)
    return cut_up.join(whole, "at").drop("at")


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the token ids of every sequence, and where its pieces
    begin. `packed` comes with ids; a sequence has at most `capacity` of them."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.offset").alias("starts"))
