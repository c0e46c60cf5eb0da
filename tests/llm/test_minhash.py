import random

import numpy as np
import pytest

from paperloom.llm import minhash
from paperloom.llm.components import components
from tests.llm.helpers import classes

SCHEMA = "doc_id long, text string, member int, band string"


def texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([1, 3, 4, 30, 120, 400]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6, len(base) // 12])):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    big = [word() for _ in range(150)]  # one large group whose members are close to some others only
    for _ in range(60):
        copy = list(big)
        for _ in range(rng.randrange(12)):
            copy[rng.randrange(len(copy))] = word()
        out.append("\n".join(copy).upper())
    out += ["", " \t", None, "x " * 3000, "X\x0by z"]
    return list(enumerate(out))


@pytest.mark.parametrize("n", [4, 5])
def test_classes_equal_those_of_all_pairs(spark, n):
    docs = texts()
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(rows, n).collect()}
    want = classes(docs, n, 80)
    assert got == want and len({c for _, c in want.values()}) < len(want) - 30


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f", 0, ""), (1, "p q r s t u", 0, ""), (2, "p q r s t u", 0, ""), (None, "a b c d e f", 0, ""), (3, None, 0, "")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found.collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    kept = minhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 3] and kept.columns == ["doc_id", "text", "member", "band"]


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_estimate_similarity_and_use_every_register():
    rng = np.random.default_rng(1)
    for size in (1, 5, 100, 2000):
        pool = rng.integers(1, 2**63, 2 * size, dtype=np.uint64)
        a, b = np.unique(pool[:size + size // 2]), np.unique(pool[size // 2:])
        x, y = minhash.signatures([a, b])
        assert (x != minhash.EMPTY).all()
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((x == y).mean() - exact) < 0.2


def test_a_single_element_serves_every_register_once():
    sig = minhash.signatures([np.array([12345], np.uint64)])[0]
    assert sorted((sig >> np.uint64(56)).tolist()) == list(range(minhash.REGISTERS))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 50)] + [(100, k) for k in range(101, 200)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[k] == 100 for k in range(100, 200)) and got[301] == 300
