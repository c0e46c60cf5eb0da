"""Greedy size-based shards, exact and distributed.

Rule: walk a source's rows in order; the row that brings the open shard to at least
`limit` bytes closes it, and the next row opens a new one from zero. Which shard a
row gets depends on every row before it, so a plain implementation needs one task
per source.

Here the walk is cut into blocks of about BLOCK_SHARDS shards of bytes. What a block
does depends only on where the shard that is open at its start began (`opened`, a
byte position in the source), and as a function of `opened` it is a step function:
each possible first closing row is one step. Blocks are summarised independently,
summaries of neighbouring blocks are composed in a tree, and going back down the
tree gives every block its true `opened`. A group of rows in one task is bounded by
a fixed number of shards, whatever the size of the source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.paths import shard_name
from paperloom.plans.ordering import running_total
from paperloom.plans.staging import stage

BLOCK_SHARDS = 8
FAN_IN = 16

_ANY = np.iinfo(np.int64).max
_UNCHANGED = -1

# A step: for `opened` <= upto (and above the previous step's upto) the block closes
# `n` shards and leaves the open shard starting at `exit`; _UNCHANGED means no close.
_STEPS = "source string, block bigint, upto bigint, exit bigint, n bigint"


def _block_steps(limit: int):
    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        ends = np.unique(pdf["end"].to_numpy())
        begin = pdf["before"].min()
        # The open shard holds less than `limit` at the block's start, so its closing
        # row ends in (begin, begin + limit], or is the first one beyond.
        first = np.arange(np.searchsorted(ends, begin, "right"), len(ends))
        first = first[: np.searchsorted(ends[first], begin + limit, "left") + 1]
        at = first.copy()
        closes = [[end] for end in ends[first]]
        alive = np.arange(len(first))
        while len(alive):
            nxt = np.searchsorted(ends, ends[at[alive]] + limit, "left")
            inside = nxt < len(ends)
            alive, nxt = alive[inside], nxt[inside]
            at[alive] = nxt
            for i, end in zip(alive, ends[nxt]):
                closes[i].append(end)
        return pd.DataFrame({
            "source": pdf["source"].iat[0],
            "block": pdf["block"].iat[0],
            "upto": np.append(ends[first] - limit, _ANY),
            "exit": np.append(ends[at], _UNCHANGED),
            "n": [len(c) for c in closes] + [0],
            "closes": closes + [[]],
        })

    return steps


def _lookup(steps: pd.DataFrame, opened: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each `opened` is left by a block, and how many shards it closes."""
    hit = np.searchsorted(steps["upto"].to_numpy(), opened, "left")
    left = steps["exit"].to_numpy()[hit]
    return np.where(left == _UNCHANGED, opened, left), steps["n"].to_numpy()[hit]


def _in_order(pdf: pd.DataFrame):
    """The blocks of a group in order, each with its steps in order."""
    for block, steps in pdf.sort_values(["block", "upto"]).groupby("block", sort=False):
        yield block, steps


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The step function of a run of neighbouring blocks."""
    run = None
    for _, steps in _in_order(pdf):
        steps = steps[["upto", "exit", "n"]]
        if run is None:
            run = steps
            continue
        closed = run[run["exit"] != _UNCHANGED]
        # `opened` values that pass the earlier blocks unchanged meet this one directly.
        direct = steps if closed.empty else steps[steps["upto"] > closed["upto"].max()]
        left, n = _lookup(steps, closed["exit"].to_numpy())
        closed = closed.assign(exit=left, n=closed["n"].to_numpy() + n)
        run = pd.concat([closed, direct], ignore_index=True)
        # Neighbouring steps with the same outcome are one step.
        outcome = run[["exit", "n"]].to_numpy()
        run = run[np.append((outcome[1:] != outcome[:-1]).any(axis=1), True)]
    return run.assign(source=pdf["source"].iat[0], block=pdf["parent"].iat[0])


def _descend(pdf: pd.DataFrame) -> pd.DataFrame:
    """From the state at the start of a run to the state at the start of each block."""
    opened, closed = pdf["opened"].to_numpy()[:1], pdf["closed"].to_numpy()[:1]
    rows = []
    for block, steps in _in_order(pdf):
        rows.append((block, opened[0], closed[0]))
        opened, n = _lookup(steps, opened)
        closed = closed + n
    out = pd.DataFrame(rows, columns=["block", "opened", "closed"])
    return out.assign(source=pdf["source"].iat[0])


def _block_entries(steps: DataFrame, top_block: int) -> DataFrame:
    """(source, block, opened, closed): the state in which each block is entered."""
    levels = [steps]
    parent = F.floor(F.col("block") / F.lit(FAN_IN)).cast("bigint").alias("parent")
    # Steps are few bytes and much work: without a number adaptive execution gives all to one task.
    tasks = steps.sparkSession.sparkContext.defaultParallelism
    while top_block >= FAN_IN:
        grouped = levels[-1].select("*", parent).repartition(tasks, "source", "parent").groupBy("source", "parent")
        levels.append(stage(grouped.applyInPandas(_compose, _STEPS)))
        top_block //= FAN_IN
    zero = F.lit(0).cast("bigint")
    entries = levels[-1].select("source", zero.alias("parent")).distinct()
    entries = entries.select("*", zero.alias("opened"), zero.alias("closed"))
    if top_block == 0:
        return entries.withColumnRenamed("parent", "block")
    for level in reversed(levels):
        entries = (
            level.select("*", parent)
            .join(entries, ["source", "parent"])
            .groupBy("source", "parent")
            .applyInPandas(_descend, "source string, block bigint, opened bigint, closed bigint")
            .withColumnRenamed("block", "parent")
        )
    return entries.withColumnRenamed("parent", "block")


def assign_shards(sizes: DataFrame, limit: int) -> DataFrame:
    """Add shard, shard_total and shard_file to (source, path, chunk_index, nbytes).

    `shard` counts from zero within a source; `shard_total` is the number of shards of
    the source. (source, path, chunk_index) is unique.
    """
    if limit <= 0:
        raise ValueError("a shard must hold at least one byte")
    end = F.col("before") + F.col("nbytes")
    block = F.floor(F.col("before") / F.lit(limit * BLOCK_SHARDS)).cast("bigint")
    placed = stage(
        running_total(sizes, ["source"], ["path", "chunk_index"], F.col("nbytes"), "before")
        .select("source", "path", "chunk_index", "nbytes", "before", block.alias("block"))
    )
    top_block = placed.agg(F.max("block")).first()[0] or 0
    steps = stage(
        # Rows without bytes end alike: combined before the shuffle, any number of them is one.
        placed.groupBy("source", "block", end.alias("end")).agg(F.min("before").alias("before"))
        .groupBy("source", "block")
        .applyInPandas(_block_steps(limit), f"{_STEPS}, closes array<bigint>")
    )
    entries = _block_entries(steps.drop("closes"), top_block)
    walked = (
        steps.join(entries, ["source", "block"])
        .where("upto >= opened")
        .groupBy("source", "block")
        .agg(F.first("closed").alias("closed"), F.min_by("closes", "upto").alias("closes"))
    )
    last_row = placed.groupBy("source", "block").agg(F.max("before").alias("last_before"))

    def shard_of(before: str):
        passed = F.filter("closes", lambda c: c <= F.col(before))
        return (F.col("closed") + F.size(passed)).cast("int")

    walked = walked.join(last_row, ["source", "block"])
    totals = walked.groupBy("source").agg((F.max(shard_of("last_before")) + 1).alias("shard_total"))
    walked = walked.drop("last_before").join(totals, "source")
    shard = F.col("shard")
    return (
        placed.join(walked, ["source", "block"])
        .withColumn("shard", shard_of("before"))
        .select(
            "source", "path", "chunk_index", "nbytes", "shard", "shard_total",
            shard_name(F.col("source"), shard, F.col("shard_total")).alias("shard_file"),
        )
    )
