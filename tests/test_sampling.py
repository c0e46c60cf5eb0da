"""Samples and positions against plain loops, below and above the window limit."""

import random

import pytest

from paperloom.operators import sampling as S


def make():
    rng = random.Random(5)
    rows = [("hot", f"p{i:05d}", 0, rng.choice([1, 5, 200])) for i in range(600)]
    rows += [("small", f"p{i:05d}", 0, 500) for i in range(7)]
    rows += [("few", f"p{i:05d}", i % 2, 5) for i in range(4)]
    rows += [("large_files", f"p{i:05d}", 0, 10_000) for i in range(9)]
    rng.shuffle(rows)
    return rows


def walk(rows, n, cap):
    sample, stats = [], {}
    for source in {r[0] for r in rows}:
        limit = float("inf") if source == "large_files" else cap
        taken = skipped = 0
        for r in sorted(r for r in rows if r[0] == source):
            if r[3] > limit:
                skipped += 1
                continue
            sample.append(r)
            taken += 1
            if taken == n:
                break
        stats[source] = (taken, skipped, taken + skipped)
    return sorted(sample), stats


SCHEMA = "source string, path string, chunk_index int, file_size bigint"


@pytest.mark.parametrize("threshold", ["1000", "3"])
@pytest.mark.parametrize("n", [1, 10, 10_000])
def test_bounded_sample(spark, n, threshold):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = sorted(map(tuple, S.bounded_sample(df, n, 100).collect()))
        stats = {r.source: (r.sampled, r.skipped, r.checked) for r in S.sample_stats(df, n, 100).collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert (got, stats) == walk(rows, n, 100)


def test_samples_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    plan = S.bounded_sample(df, 10, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_positions_and_batches(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    got = {(r.source, r.position): r.path for r in S.select_positions(df, [0, 3, 599]).collect()}
    assert got == {("hot", 0): "p00000", ("hot", 3): "p00003", ("hot", 599): "p00599", ("small", 0): "p00000",
                   ("small", 3): "p00003", ("few", 0): "p00000", ("few", 3): "p00003",
                   ("large_files", 0): "p00000", ("large_files", 3): "p00003"}
    sizes = S.batch_numbers(df, 100).groupBy("source", "batch").count()
    got = {(r.source, r.batch): r["count"] for r in sizes.collect()}
    assert got == {**{("hot", i): 100 for i in range(6)}, ("small", 0): 7, ("few", 0): 4, ("large_files", 0): 9}


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("s", c) for c in "ccbbaadddefg"], "source string, v string")
    got = [(r.v, r.files, r["rank"]) for r in S.top_values(df, "v").orderBy("rank").collect()]
    assert got == [("d", 3, 1), ("a", 2, 2), ("b", 2, 3), ("c", 2, 4), ("e", 1, 5)]


def test_head(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    assert [tuple(r)[:2] for r in S.head_rows(df, 2).collect()] == [("few", "p00000"), ("few", "p00001")]
