import math
import random

import numpy as np
import pytest

from paperloom.llm import maxscore

SCHEMA = "vec_id long, embedding array<float>, score long, label int"


def plain(rows, k=5, divisor=50):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(ok):
        if q is None or q % divisor:
            continue
        met = sorted((-sum(s * t for s, t in zip(x, y)), c is None, c or 0) for b, (c, y) in enumerate(ok) if b != a)
        out += [(q, r + 1, None if none else c, -s) for r, (s, none, c) in enumerate(met[:k])]
    return out


def ran(spark, rows, **options):
    return [tuple(r) for r in maxscore.top_k(spark.createDataFrame(rows, SCHEMA), **options).collect()]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SHARD", 37), ("BLOCK", 5), ("TOGETHER", 3), ("FIRST", 8), ("PROBED", 2)):
        monkeypatch.setattr(maxscore, name, value)


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) for _ in range(width)], 0, 0) for i in range(n)]


def test_equals_brute_force(spark, small):
    rows = vectors(300, 12) + [(i, [0.5] * 12, 1, 1) for i in range(300, 420)]  # many ties
    assert sorted(ran(spark, rows)) == sorted(plain(rows))
    assert sorted(ran(spark, rows, k=2, divisor=7)) == sorted(plain(rows, 2, 7))


def test_defined_cases(spark, small):
    rows = vectors(60, 4) + [(None, [1.0] * 4, 0, 0), (None, [1.0] * 4, 0, 0), (50, [0.1], 0, 0), (50, [0.1, 0.2, 0.3, 0.4, 0.5], 0, 0),
                             (100, None, 0, 0), (150, [1.0, None], 0, 0), (200, [float("nan")], 0, 0), (250, [float("inf")], 0, 0), (300, [], 0, 0), (-50, [-3.0, 2.0], 0, 0)]
    got = ran(spark, rows)
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)
    assert {r[0] for r in got} == {0, 50, 300, -50}


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 0, 0)], [(0, [], 0, 0), (50, [], 0, 0)], vectors(4, 3), [(i, [2.0, -1.0], 0, 0) for i in range(120)]])
def test_few_or_equal_vectors(spark, rows):
    assert sorted(ran(spark, rows)) == sorted(plain(rows))


def test_large_components(spark, small):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randint(0, 15) for _ in range(6)], 0, 0) for i in range(200)]
    assert sorted(ran(spark, rows)) == sorted(plain(rows))


def test_vectors_are_passed_over(monkeypatch):
    """Terms are split, and few vectors are looked up to the end."""
    rng = np.random.default_rng(0)
    centre = rng.normal(0, 1, (20, 32))
    data = np.floor(64 * (centre[np.arange(4000) % 20] + rng.normal(0, 0.2, (4000, 32)))).astype(np.float32)
    added = []
    best = maxscore.Best(10, 5)
    real = best.add
    best.add = lambda q, s, i: (added.append(len(s)), real(q, s, i))
    ids = np.arange(4000)
    own = np.full(10, -1)
    maxscore.search_shard(data[:10], np.ascontiguousarray(data[:500].T), ids[:500], own, best)
    added.clear()
    maxscore.search_shard(data[:10], np.ascontiguousarray(data[500:].T), ids[500:], own, best)
    assert sum(added) < 0.02 * 10 * 3500
    want = np.argsort(-(data[:10] @ data.T).astype(np.int64) * 10_000 + ids, axis=1)[:, :5]
    assert [b[:, 1].tolist() for b in best.found] == want.tolist()
