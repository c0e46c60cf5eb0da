import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import lm
from paperloom.llm.words import SPACED as CLASS
from paperloom.llm.words import words
from tests.llm.helpers import SPACED, lowered

SCHEMA = "doc_id long, text string, word int, c string"
SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    real = [(r.doc_id, r.text, 1, "x") for r in spark.read.parquet(SF).select("doc_id", "text").collect()]
    return real + [(None, "the The THE", 1, ""), (5_000, None, 1, ""), (5_001, " \n", 1, ""), (5_001, "unheardof of the", 1, "")]


@pytest.mark.parametrize("frequent", [1 << 18, 300, 0])
def test_base_scores_equal_a_plain_version(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = spark.createDataFrame(docs, SCHEMA)
    model = lm.fit(rows.where("doc_id < 5000 and doc_id % 7 <> 2"))
    tokens = lambda t: SPACED.findall(lowered(t)) + [None]
    counts = Counter(x for d, t, *_ in docs if d is not None and d < 5000 and d % 7 != 2 for x in tokens(t))
    n, v = sum(counts.values()), len(counts)
    key = lambda x: (x[0] if x[0] is not None else -1, x[1], x[2])
    want = sorted(((d, len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens(t)))
                   for d, t, *_ in docs), key=key)
    got = sorted((tuple(r)[:4] for r in lm.score(rows, model).collect()), key=key)
    assert (model.totals.n, model.totals.v) == (n, v)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want])


def test_scores_do_not_depend_on_what_is_broadcast(spark, docs, monkeypatch):
    rows = spark.createDataFrame(docs, SCHEMA)
    model = lm.fit(rows)
    found = []
    for frequent in (1 << 18, 50):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        found.append(sorted(r.score for r in lm.score(rows, model).collect()))
    assert np.allclose(*found, rtol=1e-5)


def test_probabilities_of_every_context_add_up_to_one(spark, docs):
    model = lm.fit(spark.createDataFrame(docs, SCHEMA))
    rows = model.words.collect()
    total = model.back @ model.unknown / lm.SAMPLES
    for r in rows:
        p = model.back @ np.array(r.root) / lm.SAMPLES
        p[r.contexts] = r.seen
        assert (p > 0).all()
        total = total + p
    assert np.allclose(total, 1)


def test_held_out_texts_are_likelier_than_by_add_one_counts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored = lm.score(rows.where(held), lm.fit(rows.where(~held))).agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert scored[1] / scored[2] > scored[0] / scored[2] + 0.3
    assert zlib.crc32(b"x") % 7 in range(7)


def test_a_context_that_tells_the_next_word_is_learned(spark):
    texts = [(i, "ab cd " * 20 + "ef gh " * 20, 1, "") for i in range(40)] + [(99, "ab cd", 1, ""), (98, "ab gh", 1, "")]
    rows = spark.createDataFrame(texts, SCHEMA)
    got = {r.doc_id: r.score for r in lm.score(rows, lm.fit(rows)).collect()}
    assert got[99] > got[98] + 0.5


def exact_tables(count, weight, discount, stirling):
    """Mean and deviation of the number of tables, by the weights of all seatings."""
    t = np.arange(1, count + 1)
    log = stirling[count, 1:count + 1] + t * np.log(weight)
    p = np.exp(log - log.max())
    mean = (t * p).sum() / p.sum()
    return mean, np.sqrt(((t - mean) ** 2 * p).sum() / p.sum())


def test_stirling_numbers_equal_sums_over_seatings():
    for discount in (0.2, 0.7):
        weight = {(): 1.0}  # seatings as sorted tuples of table sizes
        got = lm.log_stirling(discount, 6)
        for c in range(1, 7):
            new = Counter()
            for sizes, w in weight.items():
                new[tuple(sorted([*sizes, 1]))] += w
                for i, n in enumerate(sizes):
                    new[tuple(sorted([*sizes[:i], n + 1, *sizes[i + 1:]]))] += w * (n - discount)
            weight = new
            for t in range(1, c + 1):
                assert math.isclose(sum(w for sizes, w in weight.items() if len(sizes) == t), math.exp(got[c, t]))


@pytest.mark.parametrize("discount", [0.1, 0.4, 0.7, 0.9])
def test_production_sweeps_follow_the_posterior(discount):
    """Tables of words that also have many other tables, so that a new one has a fixed
    weight: the samples of a fit against the exact distribution."""
    stirling = lm.log_stirling(discount, 3000)
    for count in (10, 100, 3000):
        for weight in (0.5, 3, 30, 300):
            n, others = 200, 10_000_000
            first = np.arange(0, 2 * n + 1, 2)
            contexts, counts = np.tile([1, 2], n), np.tile([count, 1], n)
            share = weight / (others - 0.5)
            tables = np.full(lm.CLASSES, (share * 1e9 - lm.CONCENTRATION) / discount)  # of 1e9 at the root
            tables[0] = 1e9 - lm.CONCENTRATION - tables[1:].sum()
            seating = lm.Seating(lm.Totals(7, 1, np.ones(lm.CLASSES), discount, 0.5, tables), first, contexts, counts, 3)
            seating.tables[1::2] = others
            drawn = []
            for k in range(lm.SAMPLES):
                for _ in range(lm.BETWEEN if k else lm.BURN):
                    seating.sweep()
                drawn.append(seating.tables[::2].copy())
            mean, deviation = exact_tables(count, weight, discount, stirling)
            drawn = np.concatenate(drawn)
            assert abs(drawn.mean() - mean) < 0.6 * deviation + 0.02, (count, weight, drawn.mean(), mean, deviation)
            assert abs(drawn.std() - deviation) < 0.25 * deviation + 0.05, (count, weight, drawn.std(), deviation)
            assert (np.abs(drawn - mean) < 6 * deviation + 1).all()


def test_entries_of_one_word_follow_their_joint_posterior():
    """Two contexts that share a word: against the weights of all pairs of table counts."""
    discount, root = 0.5, 0.3
    tables = np.full(lm.CLASSES, 40.0)
    totals = lm.Totals(7, 1, np.ones(lm.CLASSES), discount, root, tables)
    n = 4000
    seating = lm.Seating(totals, np.arange(0, 2 * n + 1, 2), np.tile([1, 2], n), np.tile([6, 4], n), 5)
    for _ in range(12):
        seating.sweep()
    share, stirling = seating.share[0], lm.log_stirling(discount, 6)
    rising = lambda t: math.prod(i - root for i in range(1, t))
    weight = {(s, t): math.exp(stirling[6, s] + stirling[4, t]) * share ** (s + t) * rising(s + t) for s in range(1, 7) for t in range(1, 5)}
    total = sum(weight.values())
    for k, size in ((0, 6), (1, 4)):
        mean = sum(x[k] * w for x, w in weight.items()) / total
        assert abs(seating.tables[k::2].mean() - mean) < 0.06


def test_the_driver_holds_little_more_than_the_frequent_words(spark):
    texts = [(i, " ".join(f"w{(i * 400 + k) % 20_000} {chr(97 + k % 26)}" for k in range(400)), 1, "") for i in range(100)]
    model = lm.fit(spark.createDataFrame(texts, SCHEMA))
    tracemalloc.start()
    _, known, counts, logs = lm._frequent(model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(known) == model.totals.v > 20_000 and (np.diff(known) > 0).all()
    assert peak < logs.nbytes * 3
    words = {r.word: r for r in model.words.collect()}
    for at in range(0, len(known), 997):
        r = words[known[at]]
        p = model.back @ np.array(r.root) / lm.SAMPLES
        p[r.contexts] = r.seen
        assert counts[at] == r.c and np.allclose(logs[at], np.log10(p))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = lm.fit(none)
    got = lm.score(spark.createDataFrame([(1, "a b", 1, "")], SCHEMA), model).collect()
    assert [(r.n_tokens, r.n_known, r.base_score) for r in got] == [(3, 0, 0.0)] and got[0].score <= 0
    assert lm.score(none, model).count() == 0


def test_word_hashes_tell_words_apart():
    import pyarrow as pa
    text = " ".join(f"{a}{b}" for a in "abcdefghij" for b in range(5000))
    hashes = np.concatenate([w.hashes for w in words(pa.array([text, None, text]), CLASS)])
    assert len(np.unique(hashes & np.uint64(2**64 - 32))) == 50_000 and len(hashes) == 100_000


def test_every_word_before_has_a_restaurant_of_its_own(spark):
    """Words that end alike share a class, not what follows them."""
    texts = [(i, "xab cd " * 20 + "yab gh " * 20, 1, "") for i in range(40)] + [(99, "xab cd", 1, ""), (98, "xab gh", 1, "")]
    rows = spark.createDataFrame(texts, SCHEMA)
    got = {r.doc_id: r.score for r in lm.score(rows, lm.fit(rows)).collect()}
    assert got[99] > got[98] + 0.5


def tokens_of(texts, short):
    import pyarrow as pa
    for w in words(pa.array(texts, pa.string()), CLASS):
        word, first = lm._tokens(w)
        word = short.short(word)
        before = lm._before(word, first)
        for i, j in zip(first[:-1], first[1:]):
            yield list(zip(before[i:j].tolist(), word[i:j].tolist()))


@pytest.mark.parametrize("fitted, scored", [(1 << 18, 1 << 18), (300, 20), (0, 50)])
def test_pairs_and_scores_equal_a_plain_version(spark, docs, monkeypatch, fitted, scored):
    monkeypatch.setattr(lm, "FREQUENT", fitted)
    monkeypatch.setattr(lm, "PAIRS", 5_000)
    rows = spark.createDataFrame(docs, SCHEMA)
    model = lm.fit(rows.where("doc_id % 7 <> 2"))
    assert len(model.short.words) <= fitted
    trained = Counter(x for t in tokens_of([t for d, t, *_ in docs if d is not None and d % 7 != 2], model.short) for x in t)
    value = {(b, r.word): 1 - model.discount for r in model.dishes.collect() for b in r.singles}
    more = [(b, r.word, n, t) for r in model.settled.collect() for b, n, t in zip(r.befores, r.ns, r.tables)]
    assert len({x[:2] for x in more}) == len(more)
    value |= {(b, w): n - model.discount * t for b, w, n, t in more}
    assert set(value) == set(trained) and all(trained[b, w] == n for b, w, n, _ in more)
    customers, left = Counter(), Counter()
    for (before, word), n in trained.items():
        assert n == 1 or 1 - 1e-3 <= (n - value[before, word]) / model.discount <= n + 1e-3
        customers[before] += n
        left[before] += value[before, word]
    for b, c in customers.items():  # what pairs leave goes to the class
        if b < len(model.tables) and b >= 0:
            assert model.short.customers[b] == c
            assert math.isclose(left[b], c - model.discount * model.tables[b], rel_tol=1e-4, abs_tol=1e-4)
    classes = {r.word: r for r in model.words.collect()}
    unseen = model.back @ model.unknown / lm.SAMPLES

    def p(before, word):
        kind = int(model.short.of(np.array([before]))[0])
        r, parent = classes.get(word), unseen[kind]
        if r is not None:
            parent = r.seen[r.contexts.index(kind)] if kind in r.contexts else model.back[kind] @ np.array(r.root) / lm.SAMPLES
        own = value.get((before, word), 0)
        return (own + (lm.CONCENTRATION + customers[before] - left[before]) * parent) / (lm.CONCENTRATION + customers[before])

    monkeypatch.setattr(lm, "FREQUENT", scored)
    want = sorted(sum(math.log10(p(*x)) for x in t) for t in tokens_of([t for _, t, *_ in docs], model.short))
    assert np.allclose(sorted(r.score for r in lm.score(rows, model).collect()), want, rtol=1e-5)


def test_packed_numbers_come_back():
    for kind in (np.int64, np.uint32, np.float32):
        x = np.array([0, 1, 7, 2**31 - 1, 5], kind)
        assert (lm._unpacked(lm._packed(x), 5, kind) == x).all()


def test_a_fit_leaves_no_shuffle_files_and_only_the_tables_of_the_model(spark, docs):
    """Disk holds what the job still reads: the shared folder, and shuffle files of all
    that ended."""
    from pathlib import Path

    from paperloom.llm.staging import FREED
    from paperloom.plans.staging import shared_dir
    rows = spark.createDataFrame(docs, SCHEMA)
    shared, local = Path(shared_dir(spark).removeprefix("file:")), Path(spark.sparkContext._temp_dir).parent
    shuffles = lambda: {p for d in (local, *local.parent.glob("blockmgr-*")) for p in d.rglob("shuffle_*")}
    tables, files, setting = set(shared.iterdir()), shuffles(), spark.conf.get(FREED, None)
    model = lm.fit(rows)
    assert sorted(p.name.split("-")[0] for p in set(shared.iterdir()) - tables) == ["dishes", "model", "settled"]
    assert not shuffles() - files and spark.conf.get(FREED, None) == setting
    lm.score(rows, model).collect()
    assert shuffles() - files  # they would have been found
    assert sorted(p.name.split("-")[0] for p in set(shared.iterdir()) - tables) == ["dishes", "model", "scored", "settled"]


def test_only_tables_that_can_be_deleted_are(tmp_path):
    from paperloom.llm.staging import dropped
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part").write_text("x")
    dropped("nosuchstore://x/y", f"file://{tmp_path}/missing", f"file://{tmp_path}/a")
    assert [p.name for p in tmp_path.iterdir()] == ["b"]


def test_tokens_are_staged_once(spark, docs):
    """The word before is the one in front of it, so it is not kept beside each word."""
    import pyarrow as pa
    text = pa.array([t for _, t, *_ in docs], pa.string())
    numbers = (np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64), np.zeros(1))
    batch = pa.record_batch([pa.array(range(len(text)), pa.int64()), pa.array([d for d, *_ in docs], pa.int64()), text], ["row", "doc_id", "text"])

    class Shared:
        value = numbers, np.array([lm.END]), np.zeros(1)

    out = pa.Table.from_batches(lm._scorer(Shared)([batch])).to_pylist()
    packed = [r for r in out if r["size"] is not None]
    want = [(i, *x, x[1] == lm.END) for i, t in enumerate(tokens_of(text.to_pylist(), lm.Short(*numbers))) for x in t]
    got = [x for b in pa.Table.from_pylist(packed).to_batches() for part in lm._unrolled(b) for x in zip(*(y.tolist() for y in part))]
    assert got == want and sum(r["n_tokens"] for r in out if r["size"] is None) == len(want)
