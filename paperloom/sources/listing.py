"""Distributed listing of file trees.

Spark's own binary file source leaves out names starting with `.` or `_` and empty
files, so trees are listed here by tasks. A task walks below the folders it was
given until it has seen a bounded number of entries and hands back the folders it
did not reach; those are spread over all tasks in the next pass. The driver sees
roots only, never files.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.plans.staging import stage
from paperloom.schema import FILES
from paperloom.sources.storage import list_dir

FOUND = (
    "source string, root string, path string, is_dir boolean, "
    "file_size bigint, modified_us bigint"
)
_COLUMNS = ["source", "root", "path", "is_dir", "file_size", "modified_us"]


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
    columns = zip(*rows) if rows else [[] for _ in types]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, _COLUMNS)


def walker(budget: float, batch_rows: int = 10_000):
    """A mapInArrow function listing below folder rows; file rows pass unchanged.

    Having seen `budget` entries below a batch's folders it returns the folders it did
    not reach; every non-empty batch advances by one folder at least.
    """

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            queue: deque = deque()
            for row in zip(*(batch.column(c).to_pylist() for c in _COLUMNS)):
                if row[3]:
                    queue.append(row[:3])
                else:
                    rows.append(row)
            seen = 0
            while queue:
                source, root, folder = queue.popleft()
                if seen >= budget:
                    rows.append((source, root, folder, True, 0, 0))
                    continue
                for entry in list_dir(f"{root}/{folder}" if folder else root):
                    seen += 1
                    path = f"{folder}/{entry.name}" if folder else entry.name
                    if entry.is_dir:
                        queue.append((source, root, path))
                        continue
                    rows.append((source, root, path, False, entry.size, entry.modified_us))
                    if len(rows) >= batch_rows:
                        yield to_batch(rows)
                        rows = []
        yield to_batch(rows)

    return walk


def list_files(
    spark: SparkSession, roots: dict[str, str], entries_per_task: int = 20_000
) -> DataFrame:
    """All files below each `{source: root}`, as (source, root, path, file_size, modified_us)."""
    start = [(source, root.rstrip("/"), "", True, 0, 0) for source, root in roots.items()]
    pending = spark.createDataFrame(start, FOUND)
    tasks = spark.sparkContext.defaultParallelism
    passes = []
    while True:
        spread = pending.repartition(tasks, "source", "path")
        found = stage(spread.mapInArrow(walker(entries_per_task), FOUND))
        passes.append(found.where(~F.col("is_dir")).select(FILES.fieldNames()))
        pending = found.where("is_dir")
        if pending.isEmpty():
            return reduce(DataFrame.unionAll, passes)
