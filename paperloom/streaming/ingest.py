"""Streaming ingest of growing folders, and streaming deduplication."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from paperloom.schema import FILES
from paperloom.sources.listing import FOUND, to_batch, walker

FORMAT = "paperloom_folder"
ENTRIES_FIRST = 20_000
#: Rows of a batch of Arrow, and rows of a manifest that a task holds before it combines them.
BATCH_ROWS, HELD_ROWS = 10_000, 200_000


class FolderReader(DataSourceStreamReader):
    """One row per micro-batch: the root folder, to be listed as it is at that time."""

    def __init__(self, source: str, root: str):
        self.source, self.root = source, root

    def initialOffset(self) -> dict:
        return {"listed_ms": 0}

    def latestOffset(self) -> dict:
        return {"listed_ms": int(time.time() * 1000)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(self.root)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield to_batch([(self.source, partition.value, "", True, 0, 0)])


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return FOUND

    def streamReader(self, schema) -> FolderReader:
        return FolderReader(self.options["source"], self.options["path"].rstrip("/"))


def stream_files(spark: SparkSession, source: str, root: str) -> DataFrame:
    """A stream of files (schema FILES) below `root`, each once over the life of the
    checkpoint.

    Every micro-batch lists the tree in tasks: one for its upper part, then all folders
    it did not reach in parallel. State decides what is new, not modification times, so
    a file arriving late with an old time is not lost. State is one key per file; use
    the RocksDB state store for large trees.
    """
    spark.dataSource.register(FolderSource)
    start = spark.readStream.format(FORMAT).option("source", source).load(root)
    upper = start.mapInArrow(walker(ENTRIES_FIRST), FOUND)
    listed = upper.repartition("source", "path").mapInArrow(walker(float("inf")), FOUND)
    return listed.select(FILES.fieldNames()).dropDuplicates(["source", "path"])


def _first_of_each(keys: list[str], held_rows: int = 0):
    """Keep the row with the least `ord` of each pair: of each batch of input, or with
    `held_rows` of a task's whole input, where so many rows are held before they are combined."""
    def least(table: pa.Table) -> pa.Table:
        at = table.append_column("_at", pa.array(range(len(table)), pa.int64())).sort_by("ord")
        first = at.group_by(keys, use_threads=False).aggregate([("_at", "first")])
        return table.take(first.column("_at_first").sort().combine_chunks())

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held_rows:
            for batch in batches:
                yield from least(pa.Table.from_batches([batch])).combine_chunks().to_batches()
            return
        held, size, limit = [], 0, held_rows
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += len(batch)
            if size > limit:
                held = [least(pa.concat_tables(held))]
                size = len(held[0])
                limit = max(held_rows, 2 * size)
        if held:
            yield from least(pa.concat_tables(held)).combine_chunks().to_batches(max_chunksize=BATCH_ROWS)
    return combine


def _survivor(fields: list[str], keep_ms: int):
    """The row with the least `ord` of a pair that was not seen yet; state is its `ord`."""
    def first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, row = None, None
        for rows in frames:
            ords = rows["ord"].to_numpy()
            at = int(ords.argmin())
            if best is None or ords[at] < best:
                best, row = int(ords[at]), rows.iloc[[at]]
        if not state.exists:
            state.update((best,))
            yield row[fields]
        state.setTimeoutDuration(keep_ms)
    return first


def stream_dedupe(manifest: DataFrame, keep_days: float | None = None) -> DataFrame:
    """The first row of each (path, md5) in `ord`; rows without md5 pass. Rows of several
    folders carry `source`, which is then part of the key, as in `dedupe_manifest`.

    A manifest grows at its end: what comes in a later batch has a greater `ord`, so the
    rows kept are those that `dedupe_manifest` keeps of the whole. Repeats are combined
    within each batch of input, so a pair making up a third of the stream does not flood
    the task that keeps its state. State is the pairs. It grows with them, or with `keep_days`
    holds those that came up within that time, called in Python pair by pair: a pair that
    stays away for longer counts as new. Such a query looks for pairs that ran out in every
    trigger, so give it an interval; `availableNow` would not end before they all have.

    Without `keep_days` the rows of a trigger are combined once more by pair, so that one row
    of each meets the state; a task holds one row per pair of its part of the trigger.
    """
    keys = [*(["source"] if "source" in manifest.columns else []), "path", "md5"]
    fields = manifest.columns
    keyed = manifest.where("md5 is not null").mapInArrow(_first_of_each(keys), manifest.schema)
    unkeyed = manifest.where("md5 is null")
    if keep_days is None:
        firsts = keyed.repartition(*keys).mapInArrow(_first_of_each(keys, HELD_ROWS), manifest.schema)
        return firsts.dropDuplicates(keys).unionAll(unkeyed)
    keep_ms = max(1, int(keep_days * 86_400_000))
    kept = keyed.groupBy(*keys).applyInPandasWithState(
        _survivor(fields, keep_ms), manifest.schema, "ord bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return kept.unionAll(unkeyed)
