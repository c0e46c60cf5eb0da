"""A hierarchical Pitman-Yor language model of whole corpora.

Words are dishes. A word is served in the restaurant of the word before it. The restaurants
of words with the same last two bytes share a parent, a class; all classes share the root. A
restaurant gets one customer for every table of its children. Restaurants are cut up by
dish: given the number of tables of each restaurant, seatings of different words do not
depend on each other, so a task samples the seating of its words in all contexts at once. A
Gibbs sweep draws how many tables an entry's customers sit at, given all other entries;
which of them sit together does not matter. An entry of one customer has one table, so only
pairs of words that occur more than once are sampled one by one. The tables of the words
before are sampled first, per word and class; then the classes and the root are, as these
tables are their customers. Predictive probabilities are averaged over the samples.

Unknown words are one outcome: with a diffuse base measure, a new table of the root always
serves a new word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import dropped, shuffles_freed, staged, staged_at
from paperloom.llm.words import BASE, SPACED, U, Words, mix, words
from paperloom.plans.staging import scratch_path

#: Classes of contexts: of the last two bytes of the word before. The first one is the start of a text.
CLASSES = 32
LOW = CLASSES - 1
CONCENTRATION = 1.0
#: Gibbs sweeps before the first sample, between samples, and samples.
BURN, BETWEEN, SAMPLES = 6, 2, 3
#: Entries of so many customers have their tables drawn exactly.
EXACT = 64
#: Groups of a word's entries that are drawn one after the other.
TURNS = 4
#: Words whose probabilities are broadcast, the most frequent ones: CLASSES numbers each.
FREQUENT = 1 << 18
#: Short numbers of words, from 1 on, are below; 64-bit ones have WORD set. 0 is the start of a text.
SHORT = 1 << 20
WORD = 1 << 62
END = int((mix(np.array([1], np.uint64)) & U(2**64 - CLASSES) | U(WORD)).view(np.int64)[0])
#: Short numbers whose sums travel together.
PART = 1 << 12
FLUSH = 2_000_000
#: Pairs of words, and rows, that are worked on at once.
PAIRS, ROWS = 1_500_000, 50_000


def _tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, first): the word of every token of every text, an end token each; text d has
    the tokens first[d] to first[d + 1].

    A word is 58 bits of its 64-bit hash, and in the low bits its class as a context.
    """
    n = len(w.rows)
    last = w.data[w.ends - 1].astype(np.uint64)
    before = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0).astype(np.uint64)
    own = U(1) + mix(last * U(256) + before) % U(LOW)
    first = w.first + np.arange(n + 1)
    word = np.full(first[-1], END, np.int64)
    at = np.arange(len(w.starts)) + np.repeat(np.arange(n), np.diff(w.first))
    word[at] = (w.hashes & U(2**64 - CLASSES) | own | U(WORD)).view(np.int64)
    return word, first


def _before(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each token, 0 at the start of a text."""
    out = np.zeros(len(word), np.int64)
    out[1:] = word[:-1]
    out[first[:-1]] = 0
    return out


@dataclass
class Short:
    """Short numbers of frequent words: words in order, their numbers, and by number their
    classes and how often they come before another word."""

    words: np.ndarray
    numbers: np.ndarray
    classes: np.ndarray
    customers: np.ndarray

    def short(self, word: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return word
        at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
        return np.where(self.words[at] == word, self.numbers[at], word)

    def of(self, before: np.ndarray) -> np.ndarray:
        """Classes of contexts."""
        few = _is_short(before)
        return np.where(few, self.classes[np.where(few, before, 0)], before & LOW)


def _is_short(word: np.ndarray) -> np.ndarray:
    return (word >= 0) & (word < SHORT)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two numbers."""
    return mix(mix(a.astype(np.int64).view(np.uint64) + U(1)) * U(BASE) + b.astype(np.int64).view(np.uint64))


def _packed(x: np.ndarray) -> bytes:
    """Numbers compressed, their bytes of the same place together."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n).T).view(kind).ravel()


def _pieces(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, size, packed columns) of every bucket, in the order of the rows."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else [], len(b)).astype(np.int64)
    columns = [c[order] for c in columns]
    for i, j in zip(cuts[:-1], cuts[1:]):
        yield int(b[i]), int(j - i), *[_packed(c[i:j]) for c in columns]


def _summed(before: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in their order, and the sums of their numbers."""
    order = np.lexsort((word, before))
    before, word, n = before[order], word[order], n[order]
    begin = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (word[1:] != word[:-1]))) if len(word) else np.empty(0, np.int64)
    return before[begin], word[begin], np.add.reduceat(n, begin) if len(begin) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): tokens, summed over FLUSH of them at a time."""
    held, size = [], 0

    def flush():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        for k in range(0, len(word), 100_000):
            yield pa.record_batch([pa.array(word[k:k + 100_000]), pa.array(n[k:k + 100_000].astype(np.int64))], ["word", "n"])

    for batch in batches:
        for w in words(batch.column(0), SPACED):
            held.append(_tokens(w)[0])
            size += len(held[-1])
            if size > FLUSH:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


COUNTED = "bucket int, size int, before binary, word binary, n binary"


def _count_pairs(shared: Broadcast, buckets: int):
    """Pairs of a word and the one before, summed over PAIRS of them at a time and packed by
    word and class of the context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, held, size = Short(*shared.value), [], 0

        def flush():
            before, word = (np.concatenate(x) for x in zip(*held))
            few = _is_short(before) & _is_short(word)
            packed, n = np.unique(before[few] << 20 | word[few], return_counts=True)
            rest = _summed(before[~few], word[~few], np.ones((~few).sum(), np.int64))
            before, word, n = (np.concatenate(x) for x in zip((packed >> 20, packed & (SHORT - 1), n), rest))
            bucket = (_mixed(word, short.of(before)) % U(buckets)).astype(np.int32)
            rows = list(_pieces(bucket, before, word, n.astype(np.uint32)))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                                  ["bucket", "size", "before", "word", "n"])

        for batch in batches:
            for w in words(batch.column(0), SPACED):
                word, first = _tokens(w)
                word = short.short(word)
                held.append((_before(word, first), word))
                size += len(word)
                if size > PAIRS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()
    return run


DISHES = "word long, class int, singles array<long>, befores array<long>, ns array<long>"


def _dishes(shared: Broadcast):
    """One row per word and class of contexts: the words before that had it once, and the
    others with their counts. Rows come by bucket, and a bucket holds all of a word and class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, held, last = Short(*shared.value), [], None

        def flush():
            before, word, n = _summed(*(np.concatenate(x) for x in zip(*held)))
            yield _grouped(word, short.of(before), before, n)

        for batch in batches:
            for bucket, size, before, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != last and held:
                    yield from flush()
                    held = []
                last = bucket
                held.append((_unpacked(before, size, np.int64), _unpacked(word, size, np.int64), _unpacked(n, size, np.uint32).astype(np.int64)))
        if held:
            yield from flush()
    return run


def _grouped(word: np.ndarray, kind: np.ndarray, before: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((before, kind, word))
    word, kind, before, n = word[order], kind[order], before[order], n[order]
    begin = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (kind[1:] != kind[:-1])))
    first = np.append(begin, len(word))
    single = n == 1
    ones, more = (np.append(0, np.cumsum(x))[first] for x in (single, ~single))
    return pa.record_batch([pa.array(word[begin]), pa.array(kind[begin].astype(np.int32)), _lists(ones, before[single]),
                            _lists(more, before[~single]), _lists(more, n[~single])], ["word", "class", "singles", "befores", "ns"])


def _lists(first: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of lists."""
    return column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ROWS."""
    held, size = [], 0

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()

    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= ROWS:
            yield from joined()
            held, size = [], 0
    if size:
        yield from joined()


def _sums(classes: int):
    """Sums of the tables of frequent contexts, packed in parts, and of the customers of classes (part -1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, customers = np.zeros(-(-SHORT // PART) * PART), np.zeros(classes)
        for batch in batches:
            if "singles" in batch.schema.names:
                listed = [(_flat(batch.column(c))[1], None) for c in ("singles", "befores")]
                guests = np.diff(_flat(batch.column("singles"))[0]) + np.diff(_flat(batch.column("befores"))[0])
            else:
                listed = [(_flat(batch.column("befores"))[1], _flat(batch.column("tables"))[1] - 1.0)]
                guests = batch.column("customers").to_numpy()
            customers += np.bincount(batch.column("class").to_numpy(), guests, classes)
            for before, tables in listed:
                few = _is_short(before)
                size = before[few].max(initial=-1) + 1
                total[:size] += np.bincount(before[few], None if tables is None else tables[few], size)
        parts = total.reshape(-1, PART)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.record_batch([pa.array(np.append(some, -1).astype(np.int32)), pa.array([_packed(x) for x in [*parts[some], customers]], pa.binary())],
                              ["part", "sums"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of every part. A partition holds all of a part."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, x in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
            totals[part] = totals.get(part, 0) + _unpacked(x, CLASSES if part < 0 else PART, np.float64)
    yield pa.record_batch([pa.array(list(totals), pa.int32()), pa.array([x.tolist() for x in totals.values()], pa.list_(pa.float64()))], ["part", "sums"])


def _totals(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of frequent contexts by number, and customers by class."""
    total, customers = np.zeros(-(-SHORT // PART) * PART), np.zeros(CLASSES)
    for r in rows.mapInArrow(_sums(CLASSES), "part int, sums binary").repartition("part").mapInArrow(_added, "part int, sums array<double>").collect():
        if r["part"] < 0:
            customers = np.array(r["sums"])
        else:
            total[r["part"] * PART:(r["part"] + 1) * PART] = r["sums"]
    return total[:size], customers


def _rare_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(before, tables): dishes of rare contexts, summed over some rows."""
    for batch in _blocks(batches):
        before = np.concatenate([_flat(batch.column(c))[1] for c in ("singles", "befores")])
        before, n = np.unique(before[~_is_short(before)], return_counts=True)
        yield pa.record_batch([pa.array(before), pa.array(n.astype(np.int64))], ["before", "tables"])


def _rare_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rare contexts that occur more than once, with the customers of the class for the word."""
    for batch in batches:
        (first, before), n = _flat(batch.column("befores")), _flat(batch.column("ns"))[1]
        row = np.repeat(np.arange(len(batch)), np.diff(first))
        rare = ~_is_short(before)
        row = row[rare]
        guests = np.diff(first) + np.diff(_flat(batch.column("singles"))[0])
        yield pa.record_batch([pa.array(batch.column("word").to_numpy()[row]), pa.array(batch.column("class").to_numpy()[row]),
                               pa.array(before[rare]), pa.array(n[rare]), pa.array(guests[row].astype(np.int64))], ["word", "class", "before", "n", "guests"])


RARE = "word long, class int, guests long, befores array<long>, ns array<long>, totals array<long>"


def _rare_dishes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word and class with its rare contexts. A partition holds all of a word and class."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    if not parts:
        return
    word, kind, before, n, guests, tables = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((before, kind, word))
    word, kind, before, n, guests, tables = (x[order] for x in (word, kind, before, n, guests, tables))
    begin = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (kind[1:] != kind[:-1])))
    first = np.append(begin, len(word))
    yield pa.record_batch([pa.array(word[begin]), pa.array(kind[begin]), pa.array(guests[begin]), _lists(first, before),
                           _lists(first, n), _lists(first, tables)], ["word", "class", "guests", "befores", "ns", "totals"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word with its classes of contexts and customers there. A partition holds all of a word."""
    parts = [[c.to_numpy() for c in b.columns] for b in batches]
    if not parts:
        return
    word, kind, c, customers = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((kind, word))
    word, kind, c, customers = word[order], kind[order], c[order], customers[order]
    same = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (kind[1:] != kind[:-1])))
    word, kind, c, customers = word[same], kind[same], np.add.reduceat(c, same), np.add.reduceat(customers, same)
    begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    total = np.add.reduceat(c, begin)
    first = np.append(begin, len(word))
    for k in range(0, len(begin), 20_000):
        a = first[k:k + 20_001]
        part = slice(a[0], a[-1])
        yield pa.record_batch([pa.array(word[a[:-1]]), pa.array(total[k:k + 20_000]),
                               _lists(a - a[0], kind[part].astype(np.int32)), _lists(a - a[0], customers[part])],
                              ["word", "c", "contexts", "counts"])


WORDS = "word long, c long, contexts array<int>, counts array<long>"


@dataclass
class Totals:
    """Customers and tables of all restaurants; of every sample, where there are samples."""

    n: int
    v: int
    customers: np.ndarray
    discount: float
    root_discount: float
    tables: np.ndarray


def log_stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: over all seatings of c customers at t
    tables, the sum of their weights, at [c, t]."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    tables = np.arange(1, most + 1)
    for c in range(most):
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(c - discount * tables, 0))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], out[c, 1:] + stay)
    return out


def many_tables(counts: np.ndarray, weights: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the number of tables of many customers who eat one dish, where a
    new table has the given weight.

    Tables of k customers are a Poisson number for every k, given that there are c
    customers in all; tilted so that c are expected, their number and that of the tables are
    nearly normal, or one table holds most customers and the rest are Poisson.
    """
    low, high = np.full(len(counts), -45.0), np.full(len(counts), np.log(600))
    goal = np.log(counts) - np.log(weights)

    def solved(goal: np.ndarray) -> np.ndarray:
        """y = -log(1 - z) of the tilt z, by bisection of its logarithm."""
        a, b = low, high
        for _ in range(50):
            y = np.exp((a + b) / 2)
            above = np.log(-np.expm1(-y)) + (1 - discount) * y > goal
            a, b = np.where(above, a, (a + b) / 2), np.where(above, (a + b) / 2, b)
        return np.exp((a + b) / 2)

    def spread(y: np.ndarray, weights: np.ndarray) -> np.ndarray:
        z = -np.expm1(-y)
        return weights * (z * np.exp((1 - discount) * y) + z * z * (1 - discount) * np.exp((2 - discount) * y))

    y = solved(goal)
    tables = weights * -np.expm1(-discount * y) / discount
    of_customers = spread(y, weights)
    more = spread(solved(goal - 0.01), weights * np.exp(0.01))
    several = weights * np.exp(-discount * y)  # tables of many customers
    nearly_normal = several / (several + 0.3)
    added = np.clip(-50 * np.log(more / of_customers), 0, 2)  # of second order; one table if it holds most
    mean = tables + nearly_normal * added + 1 - nearly_normal
    return mean, np.maximum(tables - counts * (counts / of_customers), 0)


class Seating:
    """Tables of a set of words, by entry (word, context)."""

    def __init__(self, totals: Totals, first: np.ndarray, contexts: np.ndarray, counts: np.ndarray, seed: int):
        #: Weight of a new table per customer of the root.
        share = (CONCENTRATION + totals.discount * totals.tables[contexts]) / (totals.tables.sum() + CONCENTRATION)
        self._open(first, counts, share, totals.discount, totals.root_discount, 0, seed)

    @classmethod
    def below(cls, first: np.ndarray, counts: np.ndarray, share: np.ndarray, discount: float, above: float, more: np.ndarray, seed: int) -> Seating:
        """Of entries whose new tables have the given weight per customer of the parent; it has
        `more` customers for each word besides, and the discount `above`, once a word."""
        seating = cls.__new__(cls)
        seating._open(first, counts, share, discount, above, more, seed)
        return seating

    def _open(self, first, counts, share, discount, above, more, seed) -> None:
        self.counts, self.first, self.share, self.discount, self.above, self.more = counts, first, share, discount, above, more
        self.word = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.rng = np.random.default_rng(seed)
        self.stirling = log_stirling(discount, EXACT)
        self.tables = np.ones(len(counts), np.int64)
        # Entries of one word depend on each other, so they take turns.
        rank = np.arange(len(counts)) - first[self.word]
        self.turns = []
        for k in range(TURNS):
            entries = np.flatnonzero((counts > 1) & (rank % TURNS == k))
            entries = entries[np.argsort(np.minimum(counts[entries], EXACT + 1), kind="stable")]
            sizes, begin = np.unique(np.minimum(counts[entries], EXACT + 1), return_index=True)
            self.turns.append((entries, list(zip(sizes.tolist(), begin, np.append(begin[1:], len(entries))))))

    def served(self) -> np.ndarray:
        """Customers of the parent for each word."""
        return np.add.reduceat(self.tables, self.first[:-1]) + self.more

    def sweep(self) -> None:
        """Draw the number of tables of every entry, given all others. An entry of one
        customer has one table."""
        for entries, groups in self.turns:
            if len(entries):
                others = self.served()[self.word[entries]] - self.tables[entries]
                for c, i, j in groups:
                    some = entries[i:j]
                    self.tables[some] = self._few(c, self.share[some], others[i:j]) if c <= EXACT else self._many(some, others[i:j])

    def _few(self, c: int, share: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Tables of entries of c customers, from their exact distribution. The n-th
        customer of the parent for a word has weight n - 1 - discount, the first one is
        always there."""
        before = np.maximum(others[:, None] + np.arange(c) - self.above, 0)
        if c:
            before[:, 0] = np.where(others > 0, before[:, 0], 1)
        log = self.stirling[c, 1:c + 1] + np.cumsum(np.log(before * share[:, None]), axis=1)
        upto = np.cumsum(np.exp(log - log.max(axis=1, keepdims=True)), axis=1)
        return 1 + (upto < self.rng.random((len(share), 1)) * upto[:, -1:]).sum(axis=1)

    def _many(self, entries: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Tables of entries of more customers, from the moments of their distribution."""
        counts = self.counts[entries]
        served = np.maximum(others + self.tables[entries], 1) - self.above
        mean, variance = many_tables(counts, self.share[entries] * served, self.discount)
        more = np.maximum(mean - 1, 1e-9)
        p = np.clip(1 - variance / more, 1e-6, 1)
        return np.clip(1 + self.rng.binomial(np.maximum(np.rint(more / p), 1).astype(np.int64), np.minimum(more / np.maximum(np.rint(more / p), 1), 1)), 1, counts)


SETTLED = "word long, class int, c long, customers long, befores array<long>, ns array<long>, tables array<float>"


def _settled(shared: Broadcast, samples: int, rare: bool):
    """Tables of the words before, averaged over the samples, and from the last one the
    customers of their class, for every word and class: those of frequent contexts, to whom
    others of the same word and class have one table each, or what rare contexts add to them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, customers, discount, above = shared.value
        for batch in _blocks(batches):
            kind, (first, befores), counts = batch.column("class").to_numpy(), _flat(batch.column("befores")), _flat(batch.column("ns"))[1]
            size = np.diff(first)
            if rare:
                c, guests, totals = np.zeros(len(kind), np.int64), batch.column("guests").to_numpy(), _flat(batch.column("totals"))[1]
            else:
                singles = np.diff(_flat(batch.column("singles"))[0]).astype(np.int64)
                c, guests = singles + np.diff(np.append(0, np.cumsum(counts))[first]), singles + size
                own = _is_short(befores)
                first = np.append(0, np.cumsum(own))[first]
                size, befores, counts = np.diff(first), befores[own], counts[own]
                totals = frequent[befores]
            some, tables, served = size > 0, np.zeros(len(counts)), guests.astype(np.int64)
            if some.any():
                share = (CONCENTRATION + discount * totals) / (CONCENTRATION + customers[np.repeat(kind, size)])
                seating = Seating.below(np.append(first[:-1][some], first[-1]), counts, share, discount, above, (guests - size)[some],
                                        int(batch.column("word")[0].as_py()) & (2**63 - 1))
                for k in range(samples):
                    for _ in range(BETWEEN if k else BURN):
                        seating.sweep()
                    tables += seating.tables / samples
                served[some] = seating.served()
            yield pa.record_batch([batch.column("word"), batch.column("class"), pa.array(c), pa.array(served - guests if rare else served), _lists(first, befores),
                                   _lists(first, counts), _lists(first, tables.astype(np.float32))],
                                  ["word", "class", "c", "customers", "befores", "ns", "tables"])
    return run


def _batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    contexts = batch.column("contexts")
    first = contexts.offsets.to_numpy() - contexts.offsets[0].as_py()
    return batch.column("word").to_numpy(), first, contexts.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()


def _seated(totals: Broadcast):
    """Tables of every entry in each sample, and per word the customers of the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            word, first, contexts, counts = _batch(batch)
            seating = Seating(Totals(*totals.value), first, contexts, counts, int(word[0]) & (2**63 - 1))
            samples, served = [], []
            for k in range(SAMPLES):
                for _ in range(BETWEEN if k else BURN):
                    seating.sweep()
                samples.append(seating.tables.copy())
                served.append(seating.served())
            yield pa.record_batch([*batch.columns, _lists(first * SAMPLES, np.stack(samples, axis=1).ravel()),
                                   _lists(np.arange(len(word) + 1) * SAMPLES, np.stack(served, axis=1).ravel())],
                                  [*batch.schema.names, "tables", "served"])
    return run


def _tables(seated: DataFrame) -> np.ndarray:
    """Tables of each context restaurant in each sample: a few numbers."""
    flat = seated.select("contexts", F.posexplode("tables").alias("at", "t")).select(
        F.get("contexts", F.expr(f"cast(at div {SAMPLES} as int)")).alias("context"), (F.col("at") % SAMPLES).alias("sample"), "t")
    out = np.zeros((CLASSES, SAMPLES))
    for r in flat.groupBy("context", "sample").agg(F.sum("t").alias("t")).collect():
        out[r["context"], r["sample"]] = r["t"]
    return out


def _discount(once: int, twice: int) -> float:
    """Discount from the numbers of types seen once and twice."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5


@dataclass
class Model:
    """A fitted model: totals, and a table of words with their averaged probabilities."""

    totals: Totals
    words: DataFrame
    #: Per context and sample, the share of the root.
    back: np.ndarray
    #: Per sample, what the root gives to all unknown words together.
    unknown: np.ndarray
    #: Discount of the words before.
    discount: float
    short: Short
    #: Tables of frequent contexts, by their short numbers.
    tables: np.ndarray
    #: All pairs of words (DISHES), and the tables of those that occur more than once (SETTLED).
    dishes: DataFrame
    settled: DataFrame


def _probabilities(totals: Broadcast, back: np.ndarray):
    """Per word: probability in the contexts it was seen in, and of the root in each sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Totals(*totals.value)
        for batch in batches:
            word, first, contexts, counts = _batch(batch)
            tables = batch.column("tables").flatten().to_numpy().reshape(-1, SAMPLES)
            served = batch.column("served").flatten().to_numpy().reshape(-1, SAMPLES)
            root = (served - t.root_discount) / (t.tables.sum(axis=0) + CONCENTRATION)
            own = (counts[:, None] - t.discount * tables) / (t.customers[contexts] + CONCENTRATION)[:, None]
            seen = (own + back[contexts] * root[np.repeat(np.arange(len(word)), np.diff(first))]).mean(axis=1)
            yield pa.record_batch([batch.column("word"), batch.column("c"), batch.column("contexts"), _lists(first, seen),
                                   _lists(np.arange(len(word) + 1) * SAMPLES, root.ravel())],
                                  ["word", "c", "contexts", "seen", "root"])
    return run


def _least(counts: DataFrame) -> int:
    """A count that at most FREQUENT words reach."""
    bucket = F.expr("cast(floor(log2(c) * 16) as int)")
    sizes = sorted(((r["b"], r["least"], r["most"], r["n"]) for r in counts.groupBy(bucket.alias("b")).agg(
        F.min("c").alias("least"), F.max("c").alias("most"), F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, least = 0, None
    for _, low, _, n in sizes:
        total += n
        if total > FREQUENT:
            break
        least = low
    if least is None:
        least = sizes[0][2] + 1 if sizes else 1
    return least


def _shortened(texts: DataFrame) -> Short:
    """Short numbers of frequent words, the most frequent ones first."""
    place = scratch_path(texts.sparkSession, "vocabulary")
    counts = staged_at(texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("c")), place)
    ends = counts.where(F.col("word") == END).first()
    rows = counts.where(F.col("c") >= _least(counts)).toArrow()
    dropped(place)
    word, c = rows.column("word").to_numpy(), rows.column("c").to_numpy()
    numbers = np.empty(len(word), np.int64)
    numbers[np.lexsort((word, -c))] = np.arange(1, len(word) + 1)
    classes, customers = np.zeros(len(word) + 1, np.int64), np.zeros(len(word) + 1)
    classes[numbers], customers[numbers] = word & LOW, np.where(word == END, 0, c)
    customers[0] = ends["c"] if ends else 0
    order = np.argsort(word)
    return Short(word[order], numbers[order], classes, customers)


def _settle(texts: DataFrame) -> tuple[DataFrame, DataFrame, np.ndarray, Short, float]:
    """Seat all tokens in the restaurants of the words before them: all pairs (DISHES), their
    tables (SETTLED), and the tables of frequent contexts.

    A first run draws tables with as many tables per context as it has dishes; it gives the
    tables of frequent contexts and the customers of classes that the second run takes. For
    the weight of a new table, the customers of a class for one word sit at one table.
    """
    spark = texts.sparkSession
    short = _shortened(texts)
    shared = spark.sparkContext.broadcast(astuple(short))
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.mapInArrow(_count_pairs(shared, buckets), COUNTED)
    dishes = staged(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_dishes(shared), DISHES), "dishes")
    shared.destroy()
    guests = F.size("singles") + F.size("befores")
    seen = dishes.agg(F.sum(F.size("singles")), F.sum(F.size(F.filter("ns", lambda n: n == 2))), F.count_if(guests == 1), F.count_if(guests == 2)).first()
    discount, above = _discount(seen[0] or 0, seen[1] or 0), _discount(seen[2], seen[3])
    totals = dishes.mapInArrow(_rare_tables, "before long, tables long").groupBy("before").agg(F.sum("tables").alias("tables"))
    several = dishes.mapInArrow(_rare_entries, "word long, class int, before long, n long, guests long").join(totals, "before")
    place = scratch_path(spark, "rare")
    rare = staged_at(several.select("word", "class", "before", "n", "guests", "tables").repartition("word", "class").mapInArrow(_rare_dishes, RARE), place)

    def run(state: Broadcast, samples: int) -> DataFrame:
        return dishes.mapInArrow(_settled(state, samples, False), SETTLED).unionAll(rare.mapInArrow(_settled(state, samples, True), SETTLED))

    of_dishes, customers = _totals(dishes, len(short.classes))
    state = spark.sparkContext.broadcast((of_dishes, customers, discount, above))
    more, customers = _totals(run(state, 1), len(short.classes))
    state.destroy()
    state = spark.sparkContext.broadcast((of_dishes + more, customers, discount, above))
    settled = staged(run(state, SAMPLES), "settled")
    state.destroy()
    dropped(place)
    return dishes, settled, of_dishes + _totals(settled, len(short.classes))[0], short, discount


def fit(texts: DataFrame, text_col: str = "text") -> Model:
    """Learn the model from all rows of `texts`.

    Tokens are words (split at ASCII white space, A-Z count as a-z) and one end per text.
    Null and empty texts are an end alone. No rows give a model where every word is unknown.
    Counts and seatings cover every token; the driver holds the totals of CLASSES classes and
    of FREQUENT words. Shuffle files and tables that only a step needs go with the step.
    """
    with shuffles_freed(texts.sparkSession):
        return _fit(texts.select(text_col))


def _fit(texts: DataFrame) -> Model:
    spark = texts.sparkSession
    context = spark.sparkContext
    dishes_of, settled, tables, short, discount = _settle(texts)
    places = [scratch_path(spark, x) for x in ("words", "seated")]
    gathered = staged_at(settled.select("word", "class", "c", "customers").repartition("word").mapInArrow(_gather, WORDS), places[0])
    entry = gathered.select("c", F.inline(F.arrays_zip("contexts", "counts")))
    rows = entry.groupBy("contexts").agg(
        F.sum("counts").alias("n"), F.count(F.lit(1)).alias("dishes"), F.count_if(F.col("counts") == 1).alias("once"),
        F.count_if(F.col("counts") == 2).alias("twice")).collect()
    n, v = gathered.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    customers, dishes = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        customers[r["contexts"]], dishes[r["contexts"]] = r["n"], r["dishes"]
    in_one = gathered.groupBy(F.least(F.size("contexts"), F.lit(3)).alias("k")).count().collect()
    spread = {r["k"]: r["count"] for r in in_one}
    totals = Totals(n, v, customers, _discount(sum(r["once"] for r in rows), sum(r["twice"] for r in rows)),
                    _discount(spread.get(1, 0), spread.get(2, 0)), dishes)
    schema = WORDS + ", tables array<long>, served array<long>"
    first = gathered.mapInArrow(_seated(context.broadcast(astuple(totals))), schema)
    totals.tables = _tables(first)[:, -1]
    seated = staged_at(gathered.mapInArrow(_seated(context.broadcast(astuple(totals))), schema), places[1])
    totals.tables = _tables(seated)
    n = totals.customers[:, None] + CONCENTRATION
    back = (CONCENTRATION + totals.discount * totals.tables) / n
    root_n = totals.tables.sum(axis=0) + CONCENTRATION
    unknown = (CONCENTRATION + totals.root_discount * totals.v) / root_n
    shared = context.broadcast(astuple(totals))
    table = seated.mapInArrow(_probabilities(shared, back), "word long, c long, contexts array<int>, seen array<double>, root array<double>")
    words_of = staged(table, "model")
    dropped(*places)
    return Model(totals, words_of, back, unknown, discount, short, tables, dishes_of, settled)


def _logs(back: np.ndarray):
    """Per word: log10 of its probability in every context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            contexts = batch.column("contexts")
            p = batch.column("root").flatten().to_numpy().reshape(-1, SAMPLES) @ back.T / SAMPLES
            p[np.repeat(np.arange(len(batch)), np.diff(contexts.offsets.to_numpy())), contexts.flatten().to_numpy()] = batch.column("seen").flatten().to_numpy()
            logs = _lists(np.arange(len(batch) + 1) * CLASSES, np.log10(p).astype(np.float32).ravel())
            yield pa.record_batch([batch.column("word"), batch.column("c"), logs], ["word", "c", "logs"])
    return run


def _frequent(model: Model) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(least count, words, counts, log10 probabilities in every context) of the words above
    a count that at most FREQUENT words reach, sorted by word. The driver gets the
    logarithms as tasks made them, and holds them twice while it sorts them."""
    least = _least(model.words)
    rows = model.words.where(F.col("c") >= least).mapInArrow(_logs(model.back), "word long, c long, logs array<float>").toArrow()
    word = rows.column("word").to_numpy()
    order = np.argsort(word)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    logs = np.empty((len(order), CLASSES), np.float32)
    at = 0
    for part in rows.column("logs").chunks:
        logs[place[at:at + len(part)]] = part.flatten().to_numpy().reshape(-1, CLASSES)
        at += len(part)
    return least, word[order], rows.column("c").to_numpy()[order], logs


SCORED = ("row long, doc_id long, n_tokens long, n_known long, base double, "
          "size int, texts int, ids binary, lengths binary, words binary, hits binary, classes binary")
_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                     ("size", pa.int32()), ("texts", pa.int32()), *[(x, pa.binary()) for x in ("ids", "lengths", "words", "hits", "classes")]])
#: Tokens to be scored, by bucket; for rare words with their counts and probabilities in the class.
ASKED = "bucket int, size int, rows binary, befores binary, words binary, cs binary, ps binary"


def _bucket(before: np.ndarray, word: np.ndarray, buckets: int) -> np.ndarray:
    """Pairs of a frequent context are spread over all buckets, those of any other one go to the same."""
    return (_mixed(before, np.where(_is_short(before), word, 0)) % U(buckets)).astype(np.int32)


def _batch_of(schema: pa.Schema, columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _scorer(shared: Broadcast):
    """Per text the counts and base score of frequent words; and packed in the order of the
    texts all their tokens, which of them are frequent words, and the classes of contexts of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, known, base = shared.value
        short, held, size = Short(*numbers), [], 0

        def flush():
            ids, lengths, word, hit, kind = (np.concatenate(x) for x in zip(*held))
            packed = dict(zip(("ids", "lengths", "words", "hits", "classes"), map(_packed, (ids, lengths.astype(np.uint32), word, hit, kind.astype(np.uint8)))))
            named = {"size": len(word), "texts": len(ids)} | packed
            return _batch_of(_SCORED, {k: pa.array([v], _SCORED.field(k).type) for k, v in named.items()}, 1)

        for batch in batches:
            ids = batch.column("row").to_numpy()
            for w in words(batch.column("text"), SPACED):
                word, first = _tokens(w)
                word = short.short(word)
                text = np.repeat(np.arange(len(w.rows)), np.diff(first))
                at = np.minimum(np.searchsorted(known, word), max(len(known) - 1, 0))
                hit = known[at] == word if len(known) else np.zeros(len(word), bool)
                sums = [np.bincount(text[hit], x, len(w.rows)) for x in (np.ones(hit.sum()), base[at[hit]])]
                own = slice(w.rows.start, w.rows.stop)
                yield _batch_of(_SCORED, {
                    "row": pa.array(ids[own]), "doc_id": batch.column("doc_id").slice(w.rows.start, len(w.rows)), "n_tokens": pa.array(np.diff(first)),
                    "n_known": pa.array(sums[0].astype(np.int64)), "base": pa.array(sums[1].astype(np.float64))}, len(w.rows))
                held.append((ids[own], np.diff(first), word, hit, short.of(_before(word, first)[~hit])))
                size += len(word)
                if size > PAIRS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _unrolled(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(row, before, word, hit) of the tokens of every row of packed texts."""
    for size, texts, ids, lengths, word, hit in zip(*(batch.column(x).to_pylist() for x in ("size", "texts", "ids", "lengths", "words", "hits"))):
        lengths, word = _unpacked(lengths, texts, np.uint32).astype(np.int64), _unpacked(word, size, np.int64)
        yield np.repeat(_unpacked(ids, texts, np.int64), lengths), _before(word, np.append(0, np.cumsum(lengths))), word, _unpacked(hit, size, np.bool_)


def _others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of words that are not frequent."""
    for batch in batches:
        for (row, before, word, hit), kind in zip(_unrolled(batch), batch.column("classes").to_pylist()):
            kind = _unpacked(kind, int((~hit).sum()), np.uint8)
            yield pa.record_batch([pa.array(x[~hit]) for x in (row, before, word)] + [pa.array(kind.astype(np.int32))], ["row", "before", "word", "class"])


def _hits(buckets: int):
    """Tokens of frequent words, packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, before, word, hit in _unrolled(batch):
                row, before, word = row[hit], before[hit], word[hit]
                if len(row):
                    pieces = zip(*_pieces(_bucket(before, word, buckets), row, before, word))
                    yield pa.record_batch([pa.array(x, pa.int32() if k < 2 else pa.binary()) for k, x in enumerate(pieces)],
                                          ["bucket", "size", "rows", "befores", "words"])
    return run


def _ask(buckets: int):
    """Tokens of rare words, packed as the others are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            row, before, word, c, p = (x.to_numpy() for x in batch.columns)
            pieces = list(zip(*_pieces(_bucket(before, word, buckets), row, before, word, c, p)))
            yield pa.record_batch([pa.array(x, pa.int32() if k < 2 else pa.binary()) for k, x in enumerate(pieces)],
                                  ["bucket", "size", "rows", "befores", "words", "cs", "ps"])
    return run


def _told(buckets: int, discount: float):
    """Customers of pairs, and what the discounts leave of them, packed by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            before, word, n, value = (np.concatenate(x) for x in zip(*held))
            pieces = list(zip(*_pieces(_bucket(before, word, buckets), before, word, n.astype(np.uint32), value.astype(np.float32))))
            return pa.record_batch([pa.array(x, pa.int32() if k < 2 else pa.binary()) for k, x in enumerate(pieces)],
                                   ["bucket", "size", "befores", "words", "ns", "values"])

        for batch in batches:
            (first, before) = _flat(batch.column(1))
            if not len(before):
                continue
            word = np.repeat(batch.column(0).to_numpy(), np.diff(first))
            n, tables = (_flat(batch.column(k))[1] for k in (2, 3)) if batch.num_columns > 2 else (np.ones(len(word)), np.ones(len(word)))
            held.append((before, word, n, n - discount * tables))
            size += len(word)
            if size > PAIRS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()
    return run


SUMS = "row long, n_known long, base double, score double"


def _answer(shared: Broadcast, scale: float):
    """Sums over the tokens of each text that ask one bucket."""
    def run(asked: pa.Table, told: pa.Table) -> pa.Table:
        numbers, known, logs, tables, discount = shared.value
        short = Short(*numbers)
        pairs = [(_unpacked(b, n, np.int64), _unpacked(w, n, np.int64), _unpacked(c, n, np.uint32), _unpacked(v, n, np.float32))
                 for n, b, w, c, v in zip(*(told.column(x).to_pylist() for x in ("size", "befores", "words", "ns", "values")))]
        before, word, n, values = (np.concatenate(x) for x in zip(*pairs)) if pairs else [np.empty(0, x) for x in (np.int64, np.int64, np.uint32, np.float32)]
        keys = _mixed(before, word)
        order = np.argsort(keys)
        few = _is_short(before)
        rare, place = np.unique(before[~few], return_inverse=True)
        of_rare = [np.bincount(place, x[~few], len(rare)) for x in (n, values)]
        keys, values = keys[order], values[order]
        del pairs, before, word, n, order, few, place

        def find(sorted_, wanted, found):
            if not len(sorted_):
                return np.zeros(len(wanted))
            at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
            return np.where(sorted_[at] == wanted, found[at], 0).astype(np.float64)

        out = []
        for i in range(len(asked)):
            size, rows, before, word, c, p = (asked.column(x)[i].as_py() for x in ("size", "rows", "befores", "words", "cs", "ps"))
            rows, before, word = (_unpacked(x, size, np.int64) for x in (rows, before, word))
            if p is None:
                found, base = np.zeros(size), np.zeros(size)
                p = 10.0 ** logs[np.searchsorted(known, word), short.of(before)]
            else:
                c = _unpacked(c, size, np.int64)
                found, base, p = c > 0, np.log10(c + 1.0) - scale, _unpacked(p, size, np.float64)
            few = _is_short(before)
            n, left = short.customers[np.where(few, before, 0)], discount * tables[np.where(few, before, 0)]
            n[~few] = find(rare, before[~few], of_rare[0])
            left[~few] = n[~few] - find(rare, before[~few], of_rare[1])
            p = np.log10((find(keys, _mixed(before, word), values) + (CONCENTRATION + left) * p) / (CONCENTRATION + n))
            row, place = np.unique(rows, return_inverse=True)
            out.append((row, *[np.bincount(place, x, len(row)) for x in (found, base, p)]))
        row, found, base, score = (np.concatenate(x) for x in zip(*out)) if out else [np.empty(0)] * 4
        return pa.table([pa.array(row.astype(np.int64)), pa.array(found.astype(np.int64)), pa.array(base), pa.array(score)], ["row", "n_known", "base", "score"])
    return run


def _of(table: np.ndarray, index: Column) -> Column:
    return F.get(F.array(*[F.lit(float(x)) for x in table]), index)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row: log10 probabilities of
    the whole text by add-one counts of words, and by the model.

    Words, and their probabilities in every class, are looked up in a broadcast table of fixed
    size if frequent, and joined with the model otherwise. All tokens then meet the pairs of
    words in buckets, packed. Null and empty texts are an end alone. Every row is scored by
    itself, repeated and null ids included. Other columns are ignored.
    """
    t, spark = model.totals, docs.sparkSession
    context = spark.sparkContext
    scale = float(np.log10(t.n + t.v + 1))
    least, known, counts, logs = _frequent(model)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), t.n >> 22)
    numbers = astuple(model.short)
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = context.broadcast((numbers, known, np.log10(counts + 1.0) - scale))
    with shuffles_freed(spark):
        parts = staged(named.mapInArrow(_scorer(shared), SCORED), "scored")
    shared.destroy()
    texts, packed = parts.where("size is null"), parts.where("size is not null").select("size", "texts", "ids", "lengths", "words", "hits", "classes")
    tokens = packed.mapInArrow(_others, "row long, before long, word long, class int")
    joined = tokens.join(model.words.where(F.col("c") < least), "word", "left")
    root = sum(_of(model.back[:, s], F.col("class")) * F.get("root", F.lit(s)) for s in range(SAMPLES)) / SAMPLES
    unseen = _of(model.back @ model.unknown / SAMPLES, F.col("class"))
    place = F.array_position("contexts", F.col("class"))
    p = F.when(F.col("c").isNull(), unseen).when(place > 0, F.get("seen", (place - 1).cast("int"))).otherwise(root)
    rare = joined.select("row", "before", "word", F.coalesce("c", F.lit(0)).cast("long").alias("c"), p.alias("p")).mapInArrow(_ask(buckets), ASKED)
    hits = packed.drop("classes").mapInArrow(_hits(buckets), "bucket int, size int, rows binary, befores binary, words binary")
    asked = hits.select(
        "bucket", "size", "rows", "befores", "words", *[F.lit(None).cast("binary").alias(x) for x in ("cs", "ps")]).unionByName(rare)
    kind = "bucket int, size int, befores binary, words binary, ns binary, values binary"
    told = model.dishes.select("word", "singles").mapInArrow(_told(buckets, model.discount), kind).unionAll(
        model.settled.select("word", "befores", "ns", "tables").mapInArrow(_told(buckets, model.discount), kind))
    answer = _answer(context.broadcast((numbers, known, logs, model.tables, model.discount)), scale)
    sums = asked.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(answer, SUMS)
    zero = F.lit(0).cast("long")
    both = texts.select("row", "doc_id", "n_tokens", "n_known", "base", F.lit(0.0).alias("score")).unionByName(
        sums.select("row", F.lit(None).cast("long").alias("doc_id"), zero.alias("n_tokens"), "n_known", "base", "score"))
    summed = both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(y) for x, y in (
        ("n_tokens", "n_tokens"), ("n_known", "n_known"), ("base", "base_score"), ("score", "score"))])
    return summed.select("doc_id", "n_tokens", "n_known", "base_score", "score")
