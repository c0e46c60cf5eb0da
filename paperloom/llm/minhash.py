"""Near-duplicate documents by SuperMinHash signatures.

Every shingle ranks the registers by a random permutation of its own, and its value in the
register of rank j lies in [j, j + 1). So each shingle serves each register exactly once,
which lowers the variance below independent hash functions, and a document is finished as
soon as every register holds a value of the rank being dealt: long documents need a rank
or two, short ones more.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import bits
from paperloom.llm.components import components
from paperloom.llm.staging import staged
from paperloom.llm.words import SPACED, U, Words, mix, shingles, words

#: 32 bands of 4 registers: a pair of similarity 0.8 meets in no band once in 10**7.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
STEP = 0x9E3779B97F4A7C15
GOLDEN = U(STEP)
EMPTY = U(2**64 - 1)
SPREAD = 64

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of several sets of 64-bit values: one row of REGISTERS values each.

    A register holds rank * 2**56 plus the 56 random bits of its value.
    """
    m = REGISTERS
    out = np.full((len(sets), m), EMPTY)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = np.concatenate([*sets, np.empty(0, np.uint64)])
    perms: np.ndarray | None = None
    first = None
    for rank in range(m):
        if not len(seed):
            break
        bits_ = mix(seed + U(STEP * (2 * rank + 1) & (2**64 - 1)))
        swap = rank + (((bits_ & U(0xFFFFFF)) * U(m - rank)) >> U(24)).astype(np.int64)
        value = (bits_ >> U(8)) | (U(rank) << U(56))
        if rank == 0:
            register, first = swap, swap
        else:
            each = np.arange(len(seed))
            if perms is None:  # the first swap is made up for those that go on
                perms = np.tile(np.arange(m, dtype=np.uint8), (len(seed), 1))
                perms[each, first] = 0
                perms[:, 0] = first
            register = perms[each, swap].astype(np.int64)
            perms[each, swap] = perms[:, rank]
        np.minimum.at(out, (doc, register), value)
        going = (out == EMPTY).any(axis=1)[doc]
        if not going.all():
            doc, seed, first = doc[going], seed[going], first[going]
            perms = perms[going] if perms is not None else None
    return out


def _banded(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band; bands of different places never share a key by design."""
    key = np.zeros((len(sig), BANDS), np.uint64)
    key += np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN
    for r in range(ROWS):
        key = mix(key + sig[:, r::ROWS])
    return key


def _sketcher(n: int):
    def of(w: Words) -> list[np.ndarray]:
        return [shingles(w.hashes[w.first[d]:w.first[d + 1]], n) for d in range(len(w.rows))]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1), SPACED):
                sets = of(w)
                ids = batch.column(0).slice(w.rows.start, len(w.rows)).cast(pa.int64())
                sizes = np.array([len(s) for s in sets], np.int64)
                a = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                b = np.array([mix(s ^ GOLDEN).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                keys = _banded(signatures(sets)).view(np.int64)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.record_batch([ids, pa.array(sizes), pa.array(a), pa.array(b), bands],
                                      ["doc_id", "n_shingles", "set_a", "set_b", "bands"])
    return sketch


def sketched(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, shingles, two sums that name its set, and its band keys."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _sketcher(n), SIGNATURE)


def _counter(n: int, with_lacks: bool):
    def full(text: str) -> np.ndarray:
        return next(shingles(w.hashes, n) for w in words(pa.array([text]), SPACED))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = lru_cache(64)(full)  # a center comes with many members
        for batch in batches:
            rows, lacks = [], [] if with_lacks else None
            for left, right in zip(batch.column("text_a"), batch.column("text_b")):
                x, y = cached(left.as_py()), cached(right.as_py())
                both = np.intersect1d(x, y, assume_unique=True)
                rows.append((len(x), len(y), len(both)))
                if lacks is not None:
                    missing = np.setdiff1d(x, both, assume_unique=True)
                    lacks.append(np.minimum(np.bincount((missing % U(SPREAD)).astype(np.int64), minlength=SPREAD), 127))
            sizes = np.array(rows, np.int64).reshape(-1, 3)
            columns = {"a": batch.column("a"), "b": batch.column("b"), **dict(zip(["size_a", "size_b", "both"], map(pa.array, sizes.T)))}
            if lacks is not None:
                flat = np.array(lacks, np.int8).reshape(-1)
                columns["lacks"] = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, SPREAD, dtype=np.int32)), pa.array(flat))
            yield pa.record_batch(list(columns.values()), list(columns))
    return count


def _compared(pairs: DataFrame, texts: DataFrame, n: int, percent: int, with_lacks: bool = False) -> DataFrame:
    """Compare the full shingle sets of the pairs (a, b): sizes, size of the intersection,
    and whether they are similar enough to be linked; `lacks` counts the shingles of a that
    b lacks, spread over SPREAD buckets by hash (127 at most)."""
    b_side = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    a_side = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    counted = pairs.join(b_side, "b").join(a_side, "a").mapInArrow(
        _counter(n, with_lacks), "a long, b long, size_a long, size_b long, both long" + ", lacks array<tinyint>" * with_lacks)
    return counted.withColumn("linked", F.expr(f"100 * both >= {percent} * (size_a + size_b - both)"))


def _shingler(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1), SPACED):
                sets = [shingles(w.hashes[w.first[d]:w.first[d + 1]], n) for d in range(len(w.rows))]
                ids = batch.column(0).slice(w.rows.start, len(w.rows)).to_numpy()
                member = np.repeat(ids, [len(s) for s in sets])
                hashes = np.concatenate(sets).view(np.int64)
                for k in range(0, len(hashes), 100_000):
                    yield pa.record_batch([pa.array(member[k:k + 100_000]), pa.array(hashes[k:k + 100_000])], ["member", "shingle"])
    return run


def _alone(members: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(member, size, alone): shingles of each member, and those that no other member has."""
    ids = members.select(F.col("member").alias("doc_id")).distinct()
    each = texts.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_shingler(n), "member long, shingle long")
    each = staged(each, "shingles")
    alone = (each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("member"))
             .where("n = 1").groupBy("member").agg(F.count(F.lit(1)).alias("alone")))
    sizes = each.groupBy("member").agg(F.count(F.lit(1)).alias("size")).join(alone, "member", "left")
    return staged(sizes.select("member", "size", F.coalesce("alone", F.lit(0)).alias("alone")), "sizes")


def _rest(shared: DataFrame, links: DataFrame, done: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between components that meet in a band, as far as no link in `links` makes
    them needless.

    A pair is compared unless a bound rules it out. Every member is compared with a pivot
    of its band's largest component, the one with fewest shingles of its own. Shingles that only
    one of the pair has are at least those that nobody else has, and the differences of what they
    add to the pivot and of what they lack of it, bucket by bucket. If this is too much for a
    link, there is none.
    """
    part = components(links)
    grouped = staged(shared.join(part.select(F.col("node").alias("member"), "root"), "member", "left")
                     .select("band", "member", F.coalesce("root", "member").alias("part")), "parts")
    sizes = grouped.groupBy("band", "part").agg(F.count(F.lit(1)).alias("members"))
    largest = (sizes.groupBy("band").agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("members", "part")).alias("main"))
               .where("parts > 1").select("band", "main"))
    mixed = staged(grouped.join(largest, "band"), "mixed")
    mixed = mixed.join(_alone(mixed, texts, n), "member")
    pivots = mixed.groupBy(F.col("part").alias("main")).agg(F.min_by("member", F.struct("alone", "member")).alias("pivot"))
    # Staged, so that the join reads a table and adaptive execution can split a hot component.
    mixed = staged(mixed.join(staged(pivots, "pivots"), "main").where("member <> pivot"), "mixed")
    around = mixed.select(F.col("pivot").alias("a"), F.col("member").alias("b")).distinct()
    around = staged(_compared(around, texts, n, percent, True), "pivots")
    known = around.select(F.col("a").alias("pivot"), F.col("b").alias("member"), "linked", "lacks",
                          (F.col("size_b") - F.col("both")).alias("added"), (F.col("size_a") - F.col("both")).alias("lacking"))
    mixed = staged(mixed.join(known, ["pivot", "member"]).select(
        "band", "member", F.when(F.col("linked"), F.col("main")).otherwise(F.col("part")).alias("part"), "main",
        "size", "alone", (F.col("added") - F.col("alone")).alias("added"), "lacking", "lacks"), "bounded")
    outside = mixed.where("part <> main").drop("main").select("band", *[
        F.col(c).alias(f"x_{c}") for c in ("member", "part", "size", "alone", "added", "lacking", "lacks")])
    least = "x_alone + alone + abs(x_added - added) + "
    quick = least + "abs(x_lacking - lacking)"
    exact = least + "aggregate(zip_with(x_lacks, lacks, (p, q) -> abs(int(p) - int(q))), 0L, (sum, d) -> sum + d)"
    enough = f"{100 + percent} * ({{}}) <= {100 - percent} * (size + x_size)"
    pairs = (outside.join(mixed, "band").where("part <> x_part and (part = main or x_member < member)")
             .where(enough.format(quick)).where(enough.format(exact))
             .select(F.least("x_member", "member").alias("a"), F.greatest("x_member", "member").alias("b")).distinct()
             .join(done, ["a", "b"], "left_anti"))
    more = _compared(staged(pairs, "pairs"), texts, n, percent).where("linked").select("a", "b")
    return around.where("linked").select("a", "b").unionByName(more)


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked if their sets of distinct n-word shingles have a Jaccard similarity
    of percent / 100 or more; words are split at ASCII white space, A-Z count as a-z, and a
    text of fewer words is one shingle. Candidates share one of BANDS bands; every link is
    confirmed on the full sets.

    Equal sets are one class with one representative, so copies make no pairs. In a band,
    all representatives are first compared with the smallest. Only where a band still holds
    several components afterwards are members outside its largest component compared with
    the others, unless a bound rules a link out: between them all candidates are either
    confirmed, refused, or already connected. Components are exact for the candidates.

    Null and empty texts have no shingles and are linked with nothing. Rows with the same id
    are one document: they share a component, which all their texts contribute to. A row
    with a null id stays by itself: component_id is null and kept is true. Other columns are
    ignored. An empty table gives an empty result.
    """
    sets = staged(sketched(docs, n, id_col, text_col), "signatures")
    filled = sets.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_a", "set_b"]
    classes = staged(filled.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    copies = (filled.select("doc_id", *same).join(classes.where("copies > 1"), same)
              .where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))

    reps = filled.join(classes.select(F.col("rep").alias("doc_id"), *same), ["doc_id", *same])
    rows = reps.select(F.col("doc_id").alias("member"), F.explode("bands").alias("band"))
    centers = rows.groupBy("band").agg(F.min("member").alias("center"), F.max("member").alias("last"))
    shared = staged(rows.join(centers.where("center < last").drop("last"), "band"), "bands")

    star = staged(shared.where("center < member").select(F.col("center").alias("a"), F.col("member").alias("b")).distinct(), "pairs")
    ids = shared.select(F.col("member").alias("doc_id")).distinct()
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = staged(bits.only(named, ids, "doc_id"), "texts")
    links = staged(_compared(star, texts, n, percent).where("linked").select("a", "b"), "links")
    more = _rest(shared, links, star, texts, n, percent)

    roots = components(links.unionAll(more).unionAll(copies))
    joined = sets.select("doc_id", "n_shingles").join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are the smallest id of their component. Rows of one id stay or
    go together; null ids, null and empty texts stay, and an empty table stays empty."""
    found = near_duplicates(docs, n, percent, id_col, text_col)
    dropped = found.where("not kept").select(F.col("doc_id").alias(id_col))
    return bits.without(docs, staged(dropped, "dropped"), id_col).select(*docs.columns)
