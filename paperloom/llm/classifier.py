"""Quality classifier: random-indexing word vectors, pooled per document, and a small
network with calibrated probabilities.

Every term has a fixed sparse random vector. A term's word vector is the sum of the random
vectors of the terms around it, so terms used alike come to lie close together. Terms are
the words and, apart from them, their shapes (runs of lower-case letters, capitals, digits
and signs). A document is the mean and the spread of its terms' vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import staged
from paperloom.llm.worker import kept
from paperloom.llm.words import BYTES, SPACED, U, Words, mix, powers, words

#: Labelled rows that the network is fitted on: the bound of the sample, taken by a hash of
#: the id. All others are only scored. Word vectors come from all rows, labelled or not.
SAMPLE = 20_000
#: Words share so many vectors by hash.
BUCKETS = 1 << 17
SIZE = 48
#: Non-zero places of a random vector, and terms on either side that make a context.
PLACES = 4
CONTEXT = 2
HIDDEN = 32
EPOCHS = 30
FEATURES = 4 * SIZE + 1

#: Lower-case letters and all beyond ASCII count as "a", capitals as "A", digits as "0".
SHAPE = np.array([0x30 if 0x30 <= b <= 0x39 else 0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else b
                  for b in range(256)], np.uint8)


def random_vectors() -> np.ndarray:
    """The fixed random vector of every bucket: PLACES times plus or minus one."""
    bits = mix(np.arange(1, BUCKETS * PLACES + 1, dtype=np.uint64)).reshape(BUCKETS, PLACES)
    out = np.zeros((BUCKETS, SIZE), np.int8)
    for k in range(PLACES):
        sign = np.where(bits[:, k] >> U(63), 1, -1)
        np.add.at(out, (np.arange(BUCKETS), (bits[:, k] % U(SIZE)).astype(np.int64)), sign)
    return out


def _shape_hashes(w: Words) -> np.ndarray:
    """Hashes of the shapes of the words: runs of one class count once."""
    kind = SHAPE[w.data]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[w.starts] = True
    rank = np.concatenate([[0], np.cumsum(first)])
    begin = np.zeros(len(kind), np.int64)
    begin[w.starts] = w.starts
    place = np.clip(rank[1:] - 1 - rank[np.maximum.accumulate(begin)], 0, 63)
    up, _ = powers(64)
    sums = np.zeros(len(kind) + 1, np.uint64)
    np.cumsum(np.where(first, BYTES[kind] * up[place], U(0)), out=sums[1:])
    return mix(sums[w.ends] - sums[w.starts])


def _terms(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of their shapes; shapes take the upper eighth."""
    shapes = BUCKETS // 8
    return ((w.hashes % U(BUCKETS - shapes)).astype(np.int64),
            (_shape_hashes(w) % U(shapes)).astype(np.int64) + BUCKETS - shapes)


def _grouped(terms: np.ndarray) -> np.ndarray:
    """Order of the terms by bucket: two radix sorts of 16 bits each."""
    order = np.argsort((terms & 0xFFFF).astype(np.uint16), kind="stable")
    return order[np.argsort((terms >> 16).astype(np.uint16)[order], kind="stable")]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the random vectors around each bucket, one row per bucket and task.

    Texts lie CONTEXT zero vectors apart, so none is the context of another. A sum around
    one term is at most 2 * CONTEXT * PLACES, which a byte holds.
    """
    random = kept("random vectors", lambda: np.concatenate([random_vectors(), np.zeros((1, SIZE), np.int8)]))
    total = np.zeros((BUCKETS, SIZE), np.int64)
    for batch in batches:
        for w in words(batch.column(0), SPACED, lower=False):
            n = len(w.starts)
            if not n:
                continue
            at = np.arange(n) + CONTEXT * np.repeat(np.arange(1, len(w.rows) + 1), np.diff(w.first))
            for terms in _terms(w):
                padded = np.full(n + CONTEXT * (len(w.rows) + 1), BUCKETS, np.int64)
                padded[at] = terms
                own = random[padded]
                around = np.zeros_like(own)
                for step in range(1, CONTEXT + 1):
                    around[step:] += own[:-step]
                    around[:-step] += own[step:]
                order = _grouped(terms)
                used, first = np.unique(terms[order], return_index=True)
                total[used] += np.add.reduceat(around[at[order]], first, axis=0, dtype=np.int32)
    used = np.flatnonzero(total.any(axis=1))
    for k in range(0, len(used), 10_000):
        part = used[k:k + 10_000]
        yield pa.record_batch([pa.array(part.astype(np.int64)), *map(pa.array, total[part].T)], ["bucket", *_columns()])


def _columns() -> list[str]:
    return [f"v{i}" for i in range(SIZE)]


def word_vectors(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """Vectors of all buckets: contexts summed over the texts, centred and of unit length.
    Whole numbers are summed, so the result does not depend on the partitions. BUCKETS rows
    reach the driver, whatever the input."""
    schema = "bucket long, " + ", ".join(f"{c} long" for c in _columns())
    sums = texts.select(text_col).mapInArrow(_contexts, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _columns()]).toPandas()
    out = np.zeros((BUCKETS, SIZE), np.float32)
    out[sums["bucket"].to_numpy(np.int64)] = sums[_columns()].to_numpy(np.float32)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)
    seen = out.any(axis=1)
    if seen.any():
        out[seen] -= out[seen].mean(axis=0)
    return out


def _counted(w: Words, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the distinct terms of every text, by text."""
    keys = np.sort(np.repeat(np.arange(len(w.rows)) * BUCKETS, np.diff(w.first)) + terms)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, count = keys[first], np.diff(np.append(first, len(keys)))
    return keys // BUCKETS, keys % BUCKETS, count.astype(np.float32)


def _pooled(w: Words, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the vectors of each text's words and shapes, and the
    logarithm of its length. A text without words is all zero."""
    n = np.diff(w.first)
    some = n > 0
    out = np.zeros((len(n), FEATURES), np.float32)
    out[:, -1] = np.log1p(n)
    if some.any():
        count = n[some][:, None]
        for k, terms in enumerate(_terms(w)):
            text, term, times = _counted(w, terms)
            at = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            rows = vectors[term]
            weighted = rows * times[:, None]
            mean = np.add.reduceat(weighted, at, axis=0) / count
            weighted *= rows
            square = np.add.reduceat(weighted, at, axis=0) / count
            out[some, 2 * k * SIZE:(2 * k + 1) * SIZE] = mean
            out[some, (2 * k + 1) * SIZE:(2 * k + 2) * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


@dataclass
class Network:
    """Two layers over scaled features; the logit is divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.centre) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the cross entropy, in a fixed order of batches."""
    rng = np.random.default_rng(0)
    scale = np.maximum(x.std(axis=0), 1e-3)
    net = Network(x.mean(axis=0), scale, rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0)
    z = (x - net.centre) / scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for k in range(0, len(z), 256):
            xs, ys = z[order[k:k + 256]], y[order[k:k + 256]]
            hidden = np.maximum(xs @ params[0] + params[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - ys) / len(xs)
            back = np.outer(error, params[2]) * (hidden > 0)
            step += 1
            for p, (m, v), g in zip(params, moments, [xs.T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.002 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    return net


def _calibrated(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """Set the temperature that makes the labels most likely."""
    logits = net.logits(x)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def train(features: np.ndarray, labels: np.ndarray) -> Network:
    """Fit on four fifths of the rows and calibrate on the rest. Without labels the
    probability is one half everywhere."""
    if not len(features):
        return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    held = np.arange(len(features)) % 5 == 4
    net = _fit(features[~held].astype(np.float64), labels[~held])
    return _calibrated(net, features[held].astype(np.float64), labels[held]) if held.any() else net


def _scorer(vectors: Broadcast, fields: Broadcast | None):
    """Map batches of (id, text) to features, or to probabilities if there is a network,
    whose fields are broadcast: a worker need not know its class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = fields and Network(*fields.value)
        for batch in batches:
            for w in words(batch.column(1), SPACED, lower=False):
                ids = batch.column(0).slice(w.rows.start, len(w.rows)).cast(pa.int64())
                pooled = _pooled(w, vectors.value)
                if net is None:
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, pooled.size + 1, FEATURES, dtype=np.int32)), pa.array(pooled.ravel()))
                    yield pa.record_batch([ids, flat], ["doc_id", "features"])
                else:
                    yield pa.record_batch([ids, pa.array(net.probabilities(pooled))], ["doc_id", "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, Network]:
    """Word vectors from all rows of `docs`, and a network from at most SAMPLE labelled ones.

    The sample has the least hashes of ids among the labels, so it does not depend on the
    order of rows. Null labels and ids are no labels; of several for one id the greatest counts,
    and of several texts with one id the one of the least hash. Only texts are inputs.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("doc_id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
    sample = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    texts = staged(texts.groupBy("doc_id").agg(least).select("doc_id", "least.text"), "labelled")
    vectors = word_vectors(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = texts.select("doc_id", "text").mapInArrow(_scorer(shared, None), "doc_id long, features array<float>")
    found = rows.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    features = found.column("features").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    return vectors, train(features, found.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, vectors: np.ndarray, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the probability of label 1.

    Null and empty texts get the probability of a text without words. Every row is scored
    by itself, repeated and null ids included; other columns are ignored. Vectors and network are
    broadcast; their size is fixed (BUCKETS x SIZE numbers).
    """
    context = docs.sparkSession.sparkContext
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(_scorer(context.broadcast(vectors), context.broadcast(astuple(net))), "doc_id long, score double")
