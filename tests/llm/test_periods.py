import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import periods
from paperloom.llm.words import SPACED as CLASS
from paperloom.llm.words import words
from tests.llm.helpers import SPACED


def plain(w, min_length=24, exponent=3):
    """Runs by trying every period at every place."""
    n, found = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, exponent * q):
                least = next(p for p in range(1, q + 1) if all(w[k] == w[k + p] for k in range(i, i + length - p)))
                if least == q:
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found)


def cut(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "a", "a " * 23, "a " * 24, "a " * 5000, "a b " * 12 + "a", "x a b c " * 8 + "y", "b " * 30 + "a " * 30,
           "é z é\x1cz " * 20, "A a " * 15, ("p q " * 5 + "r ") * 9, " ".join(f"w{i}" for i in range(4000)),
           " ".join(f"w{i % 1300}" for i in range(4000))]
    for _ in range(60):
        base = [rng.choice("abcd") for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 3)):
            at, size = rng.randrange(len(base)), rng.randint(1, 20)
            base[at:at] = base[at:at + size] * rng.randint(2, 12)
        out.append(" ".join(base))
    return out


def test_runs_equal_a_plain_version(spark):
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts())] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(df).collect()), key=repr)
    want = []
    for d, t, _ in rows:
        w = SPACED.findall(t or "")
        runs = plain(w)
        want.append((d is None, d, len(w), runs, cut(w, runs)))
    assert got == sorted(want, key=repr)
    assert sum(bool(x[3]) for x in got) > 40
    assert periods.periodic_runs(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9)), max_size=8), st.sampled_from([(6, 2), (8, 3), (24, 3), (5, 4)]))
def test_any_sequence(parts, limits):
    ids = np.array([x for p, n in parts for x in p * n], np.int64)
    assert periods.find_runs(ids, *limits) == plain(ids.tolist(), *limits)


def test_texts_without_repeated_words_are_told_by_hashes():
    column = pa.array(["a b c " * 10, None, " ".join(f"w{i}" for i in range(500)), "x " * 15, "y " * 17])
    found = [w for w in words(column, CLASS, lower=False)]
    assert [periods.repeating(w, 16).tolist() for w in found] == [[0, 4]]


def test_long_texts():
    w = ["a"] * 40_000 + ["b", "c"] * 20_000 + [str(i % 9_000) for i in range(60_000)]
    ids = np.unique(w, return_inverse=True)[1]
    assert periods.find_runs(ids) == [(0, 40_000, 1), (40_000, 40_000, 2), (80_000, 60_000, 9_000)]


def test_a_run_has_two_periods(spark):
    with pytest.raises(ValueError):
        periods.periodic_runs(spark.createDataFrame([], "doc_id long, text string"), min_exponent=1)
