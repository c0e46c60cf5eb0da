"""Periodic runs in texts, by descending-LCP Kruskal.

Suffixes of a text's words that are neighbours in lexical order are united by decreasing
length of their common prefix, in a union-find whose classes keep their positions in
order. When a union makes two positions neighbours at distance d and their suffixes share
L words, d at most, the words from the first position on have period d for d + L words.
Every run is found from its first position: no position in between shares as much.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.words import BASE, SPACED, U, Words, mix, words

#: A run has so many words, and so many periods, at least.
MIN_LENGTH = 24
MIN_EXPONENT = 3


def least_prefix(min_length: int, min_exponent: int) -> int:
    """Words that the suffixes at a run's start and one period later share at least."""
    return min_length - min_length // min_exponent


def _windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, from those of half as many."""
    found, size = hashes, 1
    while size < n:
        step = min(size, n - size)
        found, size = mix(found[:-step] * U(BASE) + found[step:]), size + step
    return found


def repeating(w: Words, n: int) -> np.ndarray:
    """Texts of a slice with n consecutive words that occur twice. Others have no runs.
    Hashes lose a few bits to the text's number; a chance hit only costs time."""
    if len(w.hashes) < n:
        return np.empty(0, np.int64)
    text = np.repeat(np.arange(len(w.rows), dtype=np.uint64), np.diff(w.first))
    found = _windows(w.hashes, n)
    whole = text[:len(found)] == text[n - 1:]
    bits = U(len(w.rows).bit_length())
    keys = np.sort((found[whole] >> bits << bits) | text[:len(found)][whole])
    return np.unique(keys[1:][keys[1:] == keys[:-1]] & ((U(1) << bits) - U(1))).astype(np.int64)


def _suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in lexical order of their suffixes, and the words each shares with the
    next, by prefix doubling: ranks[k] orders the suffixes by their first 2**k words."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    ranks, step = [np.append(rank, -1)], 1
    while True:
        after = np.zeros(n, np.int64)
        if step < n:
            after[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        ranks.append(np.append(rank, -1))
        step *= 2
    a, b = order[:-1], order[1:]
    shared = np.zeros(n - 1, np.int64)
    for k in reversed(range(len(ranks))):
        same = ranks[k][a + shared] == ranks[k][b + shared]
        shared += np.where(same, 1 << k, 0)
    return order, shared


def _neighbours(order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """(position, position, shared words) of positions that become neighbours in a class."""
    edges = np.flatnonzero(shared >= least)
    edges = edges[np.argsort(-shared[edges], kind="stable")].tolist()
    parent, members, found = {}, {}, []

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for e in edges:
        x, y = find(e), find(e + 1)
        large, small = members.pop(x, None) or [int(order[x])], members.pop(y, None) or [int(order[y])]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        length, last = int(shared[e]), -1
        for p in small:
            k = bisect(large, p)
            if k and large[k - 1] != last:  # else both were of the small class
                found.append((large[k - 1], p, length))
            if k < len(large):
                found.append((p, large[k], length))
            large.insert(k, p)
            last = p
        parent[y], members[x] = x, large
    return np.array(found, np.int64).reshape(-1, 3)


def _is_power(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether the words have a period that divides `period`."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            q = period // prime
            if np.array_equal(ids[start:end - q], ids[start + q:end]):
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal stretches of `ids` with at least `min_length`
    members and `min_exponent` (2 or more) smallest periods, by start, then period."""
    if len(ids) < min_length:
        return []
    order, shared = _suffixes(ids)
    seeds = _neighbours(order, shared, least_prefix(min_length, min_exponent))
    period = seeds[:, 1] - seeds[:, 0]
    seeds, period = seeds[period <= seeds[:, 2]], period[period <= seeds[:, 2]]
    end = seeds[:, 1] + seeds[:, 2]
    order = np.lexsort((seeds[:, 0], end, period))  # the first seed of every period and end
    start, end, period = seeds[order, 0], end[order], period[order]
    first = np.ones(len(order), bool)
    first[1:] = (period[1:] != period[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    long = end - start >= np.maximum(min_length, min_exponent * period)
    found = zip(start[long].tolist(), end[long].tolist(), period[long].tolist())
    return sorted((s, e - s, p) for s, e, p in found if not _is_power(ids, s, e, p))


def collapsed(text: str, runs: list[tuple[int, int, int]]) -> str:
    """The words of a text joined by one space, with every run cut to its first period."""
    kept = text.encode().split()  # bytes: at ASCII white space only
    if runs:
        gone = np.zeros(len(kept) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        kept = [x for x, g in zip(kept, np.cumsum(gone).tolist()) if not g]
    return b" ".join(kept).decode()


def _runs(min_length: int, min_exponent: int):
    least = least_prefix(min_length, min_exponent)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1), SPACED, lower=False):
                found: list[list[tuple[int, int, int]]] = [[] for _ in w.rows]
                for d in repeating(w, least).tolist():
                    ids = np.unique(w.hashes[w.first[d]:w.first[d + 1]], return_inverse=True)[1]
                    found[d] = find_runs(ids, min_length, min_exponent)
                part = batch.slice(w.rows.start, len(w.rows))
                texts = [collapsed(t.as_py() or "", r) for t, r in zip(part.column(1), found)]
                structs = [[dict(zip(("start", "length", "period"), x)) for x in r] for r in found]
                yield pa.record_batch([part.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(structs, kind), pa.array(texts, pa.string())],
                                      ["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: the runs (start, length, period, in
    words from 0) by start and period, and the text with every run cut to its first period.

    Words are split at ASCII white space and compared by 64-bit hashes. A run is a stretch
    with a smallest period of at most a `min_exponent`th of it, which no neighbouring word
    extends. Null and empty texts have no words and collapse to an empty text. Every row is
    treated by itself and whole, so repeated and null ids do not matter; other columns are
    ignored, and an empty table gives an empty result. Nothing is shuffled. A text that
    repeats no stretch of words is told by hashes; others take some 100 bytes a word.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(_runs(min_length, min_exponent),
                            "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
