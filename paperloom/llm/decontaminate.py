"""Benchmark decontamination by winnowing.

Of every window of consecutive k-grams the one with the least hash is kept as fingerprint.
Two texts that share `span` words share a whole window and so a fingerprint in the same
place of it: no shared span of that length is missed, though only about two of seven
k-grams are kept. Fingerprints of documents are joined with those of the benchmark, and
hits are extended to the spans around them that the benchmark contains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import bits
from paperloom.llm.staging import staged, unused
from paperloom.llm.words import ALNUM, Words, grams, words

SPAN = 10
GRAM = 5
#: Of so many consecutive k-grams one is kept.
WINDOW = SPAN - GRAM + 1


def _winnowed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word places and hashes of the fingerprints of all texts of a slice."""
    hashes = grams(w.hashes, GRAM)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), hashes[:0]
    least = hashes[:n].copy()
    for j in range(1, WINDOW):
        np.minimum(least, hashes[j:j + n], out=least)
    at = np.zeros(n, np.int64)
    for j in range(1, WINDOW):  # the rightmost of equal ones
        at[hashes[j:j + n] == least] = j
    at += np.arange(n)
    whole = np.zeros(n, bool)  # windows that lie in one text
    for a, b in zip(w.first[:-1], w.first[1:]):
        whole[a:max(a, b - SPAN + 1)] = True
    places = np.unique(at[whole])
    return places, hashes[places]


def _grams_at(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each start."""
    return grams(hashes[starts[:, None] + np.arange(n)].ravel(), n)[::n] if len(starts) else hashes[:0]


def _benchmark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, hash, words, seed): the windows of each item (seed false) and its
    fingerprints (seed true). An item of fewer words than a span is one window and one
    fingerprint."""
    for batch in batches:
        for w in words(batch.column(1), ALNUM):
            places, prints = _winnowed(w)
            for d, row in enumerate(w.rows):
                a, b = w.first[d], w.first[d + 1]
                n = min(SPAN, b - a)
                if not n:
                    continue
                windows = np.unique(grams(w.hashes[a:b], n))
                seeds = windows if n < SPAN else np.unique(prints[(places >= a) & (places < b)])
                both = np.concatenate([windows, seeds])
                yield pa.record_batch([
                    pa.array([batch.column(0)[row].as_py()] * len(both), pa.int64()), pa.array(both.view(np.int64)),
                    pa.array(np.full(len(both), n, np.int32)),
                    pa.array(np.arange(len(both)) >= len(windows))], ["item_id", "hash", "words", "seed"])


SEEDS = ("doc_id long, text_hash long, n_words long, "
         "seeds array<struct<print: long, words: int, starts: array<int>, hashes: array<long>>>")


def _documents(shared, short: list[int]):
    """Per document its words, and the fingerprints that pass the benchmark's bitmap, each
    with the windows around it."""
    def fingerprints(w: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        places, prints = _winnowed(w)
        found = bits.test(shared.value, prints.view(np.int64))
        for p, h in zip(places[found], prints[found]):
            d = int(np.searchsorted(w.first, p, "right")) - 1
            starts = np.arange(max(p - SPAN + GRAM, w.first[d]), min(p, w.first[d + 1] - SPAN) + 1)
            yield d, int(h.view(np.int64)), SPAN, starts
        for n in short:
            hashes = grams(w.hashes, n)
            for p in np.flatnonzero(bits.test(shared.value, hashes.view(np.int64))):
                d = int(np.searchsorted(w.first, p, "right")) - 1
                if p + n <= w.first[d + 1]:
                    yield d, int(hashes[p].view(np.int64)), n, np.array([p])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(2), ALNUM):
                seeds: list[list[dict]] = [[] for _ in w.rows]
                for d, h, n, starts in fingerprints(w):
                    seeds[d].append({
                        "print": h, "words": n, "starts": (starts - w.first[d]).tolist(),
                        "hashes": _grams_at(w.hashes, starts, n).view(np.int64).tolist()})
                part = [batch.column(i).slice(w.rows.start, len(w.rows)) for i in (0, 1)]
                yield pa.record_batch([
                    part[0].cast(pa.int64()), part[1], pa.array(np.diff(w.first).astype(np.int64)),
                    pa.array(seeds, pa.list_(pa.struct([
                        ("print", pa.int64()), ("words", pa.int32()), ("starts", pa.list_(pa.int32())),
                        ("hashes", pa.list_(pa.int64()))])))], ["doc_id", "text_hash", "n_words", "seeds"])
    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, spans, items) of every row of `docs`.

    Words are runs of digits, letters a-z (A-Z count as lower case) and characters beyond
    ASCII. A window is SPAN consecutive words of an item; an item of fewer words is one
    window. `spans` are the word ranges (start, words) of the document where windows of
    the items `items` occur; n_hit counts the words inside any of them. Words and windows
    are compared by 64-bit hashes.

    Null and empty texts have no words. Every row is judged by itself, so repeated and
    null ids do not matter; text_hash (xxhash64) tells rows of one id apart. Items with
    equal ids count once; windows of an item whose id is null hit, but it is not listed.
    Other columns are ignored. Empty tables on either side give no hits. Nothing grows
    with the benchmark on a driver or in a broadcast: a bitmap of fixed size sorts out
    most fingerprints before they are shuffled, the joins decide.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = staged(items.mapInArrow(_benchmark, "item_id long, hash long, words int, seed boolean"), "benchmark")
    prints = items.where("seed").select(F.col("hash").alias("print"), "words").distinct()
    short = sorted(r[0] for r in items.where(F.col("words") < SPAN).select("words").distinct().collect())
    shared = bits.bitmap(prints, F.col("print"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text")).mapInArrow(_documents(shared, short), SEEDS)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    seeds = rows.select("row", F.explode("seeds").alias("s")).select(
        "row", "s.print", "s.words", F.arrays_zip("s.starts", "s.hashes").alias("around"))
    hits = (seeds.join(prints, ["print", "words"], "left_semi")
            .select("row", "words", F.explode("around").alias("w"))
            .select("row", "words", F.col("w.starts").alias("start"), F.col("w.hashes").alias("hash")).distinct())
    windows = items.where("not seed").select("hash", "words", "item_id").distinct()
    spans = hits.join(windows, ["hash", "words"])
    found = spans.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "words"))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"))

    def cover(state, span):
        end = span["start"] + span["words"]
        fresh = F.greatest(end - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["hit"] + fresh).alias("hit"))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    found = found.withColumn("n_hit", F.aggregate("spans", start, cover, lambda s: s["hit"]))
    return rows.drop("seeds").join(found, "row", "left").select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), "spans", "items")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """The rows of `docs` without any word of a benchmark window, with the columns they came
    with. Null and empty texts stay, repeated rows as often as they came; rows of one id are
    told apart by their texts. Empty tables on either side remove nothing."""
    key, digest = unused(docs, "_id", "_hash")
    found = contamination(docs, benchmark, id_col, text_col, **columns).where("n_hit > 0")
    found = staged(found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)), "contaminated")
    named = docs.withColumns({key: F.col(id_col).cast("long"), digest: F.xxhash64(text_col)})
    return bits.without(named, found, key, digest).select(*docs.columns)
