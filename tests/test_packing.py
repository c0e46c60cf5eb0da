"""Greedy shards against a plain loop."""

import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.plans import packing
from paperloom.plans.ordering import row_positions, running_total
from pyspark.sql import functions as F

LIMIT = 100


def greedy(rows, limit):
    """{key: (shard, shard_total)} by walking each source in order."""
    shards, totals = {}, {}
    for source in {r[0] for r in rows}:
        shard, held = 0, 0
        for key in sorted(r for r in rows if r[0] == source):
            if held >= limit:
                shard, held = shard + 1, 0
            shards[key[:3]] = shard
            held += key[3]
        totals[source] = shard + 1
    return {k: (v, totals[k[0]]) for k, v in shards.items()}


def make(sizes_by_source):
    return [
        (source, f"f{i:06d}", i % 3, size)
        for source, sizes in sizes_by_source.items()
        for i, size in enumerate(sizes)
    ]


def sizes_by_source():
    rng = random.Random(7)
    return {
        "mixed": [rng.randint(0, 60) for _ in range(900)],
        "around the limit": [rng.choice([0, 0, 1, 99, 100, 101]) for _ in range(400)],
        "one row": [5],
        "zeros": [0, 0, 0],
        "equal, walks never meet": [30] * 700,
        "equal, exact limit": [25] * 400,
        "every row closes": [100] * 50,
        "rows larger than blocks": [rng.choice([1, 3, 900]) for _ in range(300)],
        "tiny rows": [1] * 3000,
        "tiny rows and zeros": [0, 1] * 500,
        "zeros after the last close": [50, 50, 0, 0],
        "ends at a close": [100, 0, 100],
    }


@pytest.mark.parametrize("block_shards,fan_in", [(1, 8), (3, 4), (16, 64)])
def test_shards_equal_a_plain_walk(spark, monkeypatch, block_shards, fan_in):
    monkeypatch.setattr(packing, "BLOCK_SHARDS", block_shards)
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    rows = make(sizes_by_source())
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "source string, path string, chunk_index int, nbytes bigint")
    found = packing.assign_shards(df, LIMIT).collect()
    got = {(r.source, r.path, r.chunk_index): (r.shard, r.shard_total) for r in found}
    assert len(found) == len(rows)
    assert got == greedy(rows, LIMIT)


def in_blocks(sizes, limit, block_bytes, fan_in):
    """Closing positions of one source, found the distributed way but without Spark."""
    rows, before = [], 0
    for size in sizes:
        rows.append((before // block_bytes, before, before + size))
        before += size
    df = pd.DataFrame(rows, columns=["block", "before", "end"]).assign(source="s")
    steps = packing._block_steps(limit)
    blocks = pd.concat([steps(g) for _, g in df.groupby("block")], ignore_index=True)
    levels = [blocks]
    while levels[-1]["block"].max() >= fan_in:
        level = levels[-1].assign(parent=levels[-1]["block"] // fan_in)
        levels.append(pd.concat([packing._compose(g) for _, g in level.groupby("parent")], ignore_index=True))
    entries = {0: (0, 0)}
    for level in reversed(levels):
        level = level.assign(parent=level["block"] // fan_in)
        found = {}
        for parent, g in level.groupby("parent"):
            opened, closed = entries[parent]
            down = packing._descend(g.assign(opened=opened, closed=closed))
            found.update({r.block: (r.opened, r.closed) for r in down.itertuples()})
        entries = found
    closes = []
    for block, (opened, closed) in sorted(entries.items()):
        assert closed == len(closes)
        here = blocks[(blocks["block"] == block) & (blocks["upto"] >= opened)]
        closes += here.sort_values("upto").iloc[0]["closes"]
    return [sum(c <= b for c in closes) for _, b, _ in rows]


@settings(max_examples=300, deadline=None)
@given(
    sizes=st.lists(st.one_of(st.integers(0, 40), st.sampled_from([0, 1, 99, 100, 101, 700])), min_size=1, max_size=120),
    limit=st.sampled_from([1, 2, 30, 100]),
    block=st.integers(1, 5),
    fan_in=st.integers(2, 5),
)
def test_block_walk_equals_a_plain_walk(sizes, limit, block, fan_in):
    rows = [("s", f"{i:06d}", 0, size) for i, size in enumerate(sizes)]
    want = greedy(rows, limit)
    got = in_blocks(sizes, limit, limit * block, fan_in)
    assert got == [want[r[:3]][0] for r in rows]


def test_null_sources_are_refused(spark):
    df = spark.createDataFrame([(None, "p", 0, 1)], "source string, path string, chunk_index int, nbytes bigint")
    with pytest.raises(Exception, match="source must not be null"):
        packing.assign_shards(df, 10)


def test_limit_must_be_positive(spark):
    df = spark.createDataFrame([("a", "p", 0, 1)], "source string, path string, chunk_index int, nbytes bigint")
    with pytest.raises(ValueError):
        packing.assign_shards(df, 0)


def test_running_total_spreads_one_source(spark):
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("source"),
        F.format_string("%06d", (F.col("id") * 7919) % n).alias("path"),
        (F.col("id") % 11).alias("v"),
    )
    rows = df.collect()
    want = {}
    for source in ("hot", "small"):
        total = 0
        for i, r in enumerate(sorted((r for r in rows if r.source == source), key=lambda r: r.path)):
            want[source, r.path] = (total, i)
            total += r.v
    totals = running_total(df, ["source"], ["path"], F.col("v"), "before")
    positions = row_positions(df, ["source"], ["path"], "at")
    got = {
        (r.source, r.path): (r.before, r["at"])
        for r in totals.join(positions.drop("v"), ["source", "path"]).collect()
    }
    assert got == want


def test_no_task_holds_a_whole_source(spark):
    """The parts of a dominating source are spread over tasks."""
    from paperloom.plans.ordering import PART

    df = spark.range(200_000).select(F.lit("hot").alias("source"), F.col("id").alias("path"))
    parts = df.repartitionByRange(8, "source", "path").withColumn(PART, F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy(PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_rows_without_bytes_are_not_one_group(spark, monkeypatch):
    steps, n = packing._block_steps, 2_000_000

    def bounded(limit):
        run = steps(limit)

        def checked(pdf):
            assert len(pdf) < 100
            return run(pdf)

        return checked

    monkeypatch.setattr(packing, "_block_steps", bounded)
    empty = F.col("id").between(100, n + 99)
    sizes = spark.range(n + 200).select(
        F.lit("s").alias("source"), F.format_string("f%07d", "id").alias("path"), F.lit(0).alias("chunk_index"),
        F.when(empty, 0).otherwise(50).cast("long").alias("nbytes"))
    shards = packing.assign_shards(sizes, LIMIT).groupBy("shard", "shard_total").count().collect()
    assert {r["shard"]: r["count"] for r in shards} == {k: n + 2 if k == 50 else 2 for k in range(100)}
    assert {r["shard_total"] for r in shards} == {100}
