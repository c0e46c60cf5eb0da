"""Writing an archive: one Snappy Parquet file per shard, under its exact name.

The sink takes rows in order, with a mark before the first one of every shard. Rows that
carry `root`, `offset` and `nbytes` instead of `content` are read where they are written,
so their bytes never enter a shuffle. What was written is published in one step
(`commits`); a write that fails leaves nothing to be read.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from paperloom import constants as C
from paperloom.functions.paths import shard_name
from paperloom.plans.ordering import running_total
from paperloom.plans.packing import assign_shards
from paperloom.plans.staging import stage
from paperloom.schema import ARCHIVE
from paperloom.sources.archive import LOCATION
from paperloom.sources.commits import Shard, begin, commit_folder, committed, publish, schema_hash, versions
from paperloom.sources.content import TASK_BYTES
from paperloom.sources.storage import AtomicFile, is_empty, read_range, resolve

FORMAT = "paperloom_shards"
ROW_GROUP_BYTES = 64 << 20
#: Ranges of shards that tasks are given; their first keys are broadcast.
MAX_RANGES = 65_536
FAILURES = "_failures"
#: Characters that Spark escapes in the names of partition folders.
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

_KEYS = ["source", "path", "chunk_index"]

_SHARD_SCHEMA = pa.schema([
    ("path", pa.string()),
    ("source", pa.string()),
    ("file_type", pa.string()),
    ("file_size", pa.int64()),
    ("extension", pa.string()),
    ("content", pa.binary()),
    ("content_available", pa.bool_()),
    ("chunk_index", pa.int32()),
    ("total_chunks", pa.int32()),
])


@dataclass
class Written(WriterCommitMessage):
    shards: list[Shard] = field(default_factory=list)
    failed: int = 0


def shard_writer(stream, schema: pa.Schema) -> pq.ParquetWriter:
    """A Parquet writer with the settings of shards. File bytes are distinct and large: a
    dictionary or min/max of them helps no one."""
    return pq.ParquetWriter(
        stream,
        schema,
        compression="snappy",
        use_dictionary=[n for n in ("source", "file_type", "extension") if n in schema.names],
        write_statistics=[n for n in schema.names if n != "content"],
    )


class ShardFile:
    """One open shard file; holds at most one row group of bytes and one batch."""

    def __init__(self, root: str, source: str, path: str, schema: pa.Schema = _SHARD_SCHEMA):
        self.source, self.path, self.schema = source, path, schema
        self.file = AtomicFile(f"{root}/{path}")
        self.parquet = shard_writer(self.file.stream, schema)
        self.held: list[pa.Table] = []
        self.size = self.rows = 0

    def add(self, rows: pa.Table) -> None:
        self.held.append(rows)
        self.size += pc.sum(pc.binary_length(rows.column("content"))).as_py() or 0
        self.rows += len(rows)
        if self.size >= ROW_GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            self.parquet.write_table(pa.concat_tables(self.held))
            self.held, self.size = [], 0

    def publish(self) -> Shard:
        self.flush()
        self.parquet.close()
        size = self.file.stream.tell()
        self.file.publish()
        return Shard(self.source, self.path, self.rows, size, schema_hash(self.schema))


class ShardWriter(DataSourceArrowWriter):
    """Writes marked rows (see `marked`) and publishes the shards as one commit."""

    def __init__(self, out: str, partitioned: bool, skip_unread: bool, version: int):
        self.out = out
        self.partitioned = partitioned
        self.skip_unread = skip_unread
        self.version = version

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, shard, failures = Written(), None, None
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                names = table.column("shard_file").to_pylist()
                marks = [k for k, name in enumerate(names) if name is not None]
                for at, until in zip([-1, *marks], [*marks, len(names)]):
                    if at >= 0:
                        if shard:
                            done.shards.append(shard.publish())
                        source = table.column("source")[at].as_py()
                        shard = ShardFile(self.out, source, f"{commit_folder(self.version)}{self._folder(source)}/{names[at]}")
                    rows = table.slice(at + 1, until - at - 1)
                    if not len(rows):
                        continue
                    if shard is None or pc.any(pc.not_equal(rows.column("source"), shard.source)).as_py():
                        raise ValueError("rows without a place in the plan")
                    for part, failed in self._with_content(rows):
                        shard.add(part.select(_SHARD_SCHEMA.names).cast(_SHARD_SCHEMA))
                        for row in failed:
                            failures = failures or AtomicFile(f"{self.out}/{FAILURES}/{uuid.uuid4().hex}.json")
                            failures.write(json.dumps(row).encode() + b"\n")
                            done.failed += 1
            if shard:
                done.shards.append(shard.publish())
                shard = None
            if failures:
                failures.publish()
                failures = None
        finally:
            for file in (shard and shard.file, failures):
                if file:
                    file.discard()
        return done

    def _with_content(self, rows: pa.Table) -> Iterator[tuple[pa.Table, list[dict]]]:
        """Rows with their content, about a row group of bytes at a time, and rows that
        could not be read."""
        if "content" in rows.column_names:
            yield rows, []
            return
        kept, blobs, failed, size = [], [], [], 0

        def emit() -> tuple[pa.Table, list[dict]]:
            return rows.take(pa.array(kept, pa.int64())).append_column("content", pa.array(blobs, pa.binary())), failed

        for k, (root, path, offset, nbytes) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("root", "path", "offset", "nbytes")))):
            try:
                blob = None if nbytes is None else read_range(f"{root}/{path}", offset, nbytes)
            except OSError as exc:
                if not self.skip_unread:
                    raise
                failed.append({c: rows.column(c)[k].as_py() for c in _KEYS} | {"error": str(exc)})
                continue
            kept.append(k)
            blobs.append(blob)
            size += len(blob or b"")
            if size >= ROW_GROUP_BYTES:
                yield emit()
                kept, blobs, failed, size = [], [], [], 0
        yield emit()

    def _folder(self, source: str) -> str:
        return f"source={_ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', source)}" if self.partitioned else source

    def commit(self, messages: list[Written | None]) -> None:
        written = [m for m in messages if m is not None]
        shards = [s for m in written for s in m.shards]
        publish(self.out, self.version, shards)
        summary = {"shards": len(shards), "rows": sum(s.rows for s in shards), "failed_rows": sum(m.failed for m in written)}
        marker = AtomicFile(f"{self.out}/_SUCCESS")
        marker.write(json.dumps(summary).encode())
        marker.publish()

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what the tasks that did not fail have written. It was never readable."""
        for message in messages:
            for shard in message.shards if message else ():
                fs, path = resolve(f"{self.out}/{shard.path}")
                with contextlib.suppress(OSError):
                    fs.delete_file(path)


class ShardSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        partitioned = self.options.get("partitioned", "true").lower() == "true"
        skip = self.options.get("on_error", "fail") == "skip"
        return ShardWriter(self.options["path"].rstrip("/"), partitioned, skip, int(self.options["version"]))


def row_bytes(rows: DataFrame) -> DataFrame:
    """(source, path, chunk_index, nbytes) of archive rows.

    The size of a whole-file row is its file_size; only chunk rows need their content
    measured, and the filter on total_chunks lets the scan skip row groups without any.
    """
    if "nbytes" in rows.columns:
        return rows.select(*_KEYS, F.coalesce("nbytes", F.lit(0)).alias("nbytes"))
    stored = F.when(F.col("content_available"), F.col("file_size")).otherwise(0)
    keys = [*_KEYS[:2], F.coalesce("chunk_index", F.lit(0)).alias("chunk_index")]
    whole = rows.where("total_chunks = 1 or total_chunks is null").select(*keys, stored.alias("nbytes"))
    chunks = rows.where("total_chunks > 1").select(
        *_KEYS, F.octet_length("content").cast("bigint").alias("nbytes")
    )
    return whole.unionByName(chunks)


def _ranges(starts: DataFrame, wanted: int) -> DataFrame:
    """Add `range` to the shards (source, shard, first, bytes, rows): about `wanted` runs
    of consecutive shards of equal weight, MAX_RANGES at most."""
    weight = F.col("bytes") + 64 * F.col("rows")
    shards, total = starts.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    each = max(1, -(-total // max(1, min(wanted, shards, MAX_RANGES))))
    placed = running_total(starts.withColumn("all", F.lit(0)), ["all"], ["source", "shard"], weight, "before")
    return placed.withColumn("range", F.floor(F.col("before") / each).cast("int")).drop("all", "before")


def _finder(shared: Broadcast):
    """Add to rows the range their key lies in: the last one that begins at or before it."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, ranges = shared.value
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in _KEYS))
            found = pa.array([ranges[max(bisect(firsts, k) - 1, 0)] for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "range"])
    return find


def marked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows in order (source, path, chunk_index) within tasks, with a mark before the first
    row of every shard: a row whose `shard_file` is not null. A shard is in one task.

    Shards are contiguous in that order. Tasks are given ranges of shards, whose first keys
    are searched by the rows, at most MAX_RANGES of them; within a range the marks and
    the sort decide. Content moves once, and nothing broadcast grows with the shards.
    """
    starts = stage(
        plan.groupBy("source", "shard").agg(
            F.min(F.struct("path", "chunk_index")).alias("first"),
            F.first("shard_total").alias("shard_total"),
            F.coalesce(F.sum("nbytes"), F.lit(0)).alias("bytes"),
            F.count("*").alias("rows"),
        )
    )
    spark = rows.sparkSession
    total = starts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    starts = stage(_ranges(starts, max(spark.sparkContext.defaultParallelism, total // TASK_BYTES)))
    firsts = starts.groupBy("range").agg(F.min(F.struct("source", "first")).alias("key")).collect()
    found = sorted((r.key.source, r.key.first.path, r.key.first.chunk_index, r.range) for r in firsts)
    shared = spark.sparkContext.broadcast(([f[:3] for f in found], [f[3] for f in found]))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes) + ", range int"
    marks = starts.select(
        "source", "first.path", "first.chunk_index", "range",
        shard_name(F.col("source"), F.col("shard"), F.col("shard_total")).alias("shard_file"),
    )
    both = rows.mapInArrow(_finder(shared), schema).unionByName(marks, allowMissingColumns=True)
    tasks = max((f[3] for f in found), default=0) + 1
    ordered = both.repartitionById(tasks, "range").sortWithinPartitions(*_KEYS, F.col("shard_file").isNull())
    return ordered.drop("range")


def archive_write(
    rows: DataFrame,
    out: str,
    max_shard_bytes: int = C.MAX_SHARD_BYTES,
    partitioned: bool = True,
    on_error: str = "fail",
    replace: bool = False,
) -> DataFrame:
    """Write archive rows as `{source}-00000-of-00003.parquet` shards below a new folder.

    Shards are planned on sizes alone; returns the plan (source, path, chunk_index,
    nbytes, shard, shard_total, shard_file). Rows are ordered by (path, chunk_index).
    Content moves once, to the task writing its shard, or not at all when the rows
    carry locations: then that task reads the files.

    Subset folders are named `source=name`, which lets Spark prune them, or just `name`
    with `partitioned=False`.

    The folder must not hold anything yet, or with `replace` an archive, which reads as it
    was until all shards of the new one are published at once. A file that cannot be read
    fails the job; with `on_error="skip"` its rows go to `read_failures` instead. Rows
    without chunk columns are written as whole files.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    out = out.rstrip("/")
    if replace:
        committed(out)  # there must be something to replace
        known = versions(out) or []
    elif not is_empty(out):
        raise FileExistsError(f"{out} is not empty")
    else:
        known = []
    begin(out)
    # Sizes are sampled before they are sorted; rows that are made on the way are made once for both.
    plan = stage(assign_shards(stage(row_bytes(rows)), max_shard_bytes))
    located = all(name in rows.columns for name in LOCATION)
    whole = {"chunk_index": F.coalesce("chunk_index", F.lit(0)), "total_chunks": F.coalesce("total_chunks", F.lit(1))}
    payload = [c for c in ARCHIVE.fieldNames() if c != "content"]
    payload += LOCATION if located else ["content"]
    rows.sparkSession.dataSource.register(ShardSink)
    (
        marked(rows.withColumns(whole).select(payload), plan)
        .write.format(FORMAT)
        .option("partitioned", partitioned)
        .option("on_error", on_error)
        .option("version", max(known, default=0) + 1)
        .mode("append")
        .save(out)
    )
    return plan


def read_failures(spark: SparkSession, out: str) -> DataFrame:
    """(source, path, chunk_index, error) of the rows that archive_write skipped."""
    schema = "source string, path string, chunk_index int, error string"
    if is_empty(f"{out}/{FAILURES}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{out}/{FAILURES}")
