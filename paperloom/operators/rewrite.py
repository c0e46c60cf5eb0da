"""Removing rows from a published archive by path."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.operators.archive import edge_files
from paperloom.plans.staging import stage
from paperloom.sources.commits import COMMIT, commit_folder, committed, publish, shards, versions
from paperloom.sources.content import spread_by_bytes
from paperloom.sources.footers import shard_footers
from paperloom.sources.shards import ShardFile
from paperloom.sources.storage import resolve


def _counter(patterns: list[str]):
    """Per shard (source, uri): rows, and rows whose path has a pattern. Reads the
    column of paths, a row group at a time."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, removed = [], []
            for uri in batch.column("file").to_pylist():
                rows = hits = 0
                fs, path = resolve(uri)
                with fs.open_input_file(path) as handle:
                    shard = pq.ParquetFile(handle)
                    for group in range(shard.num_row_groups):
                        paths = shard.read_row_group(group, columns=["path"]).column("path")
                        rows += len(paths)
                        hits += pc.sum(_hits(paths, patterns)).as_py() or 0
                before.append(rows)
                removed.append(hits)
            counts = [pa.array(x, pa.int64()) for x in (before, removed)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], [*batch.schema.names, "rows_before", "rows_removed"])
    return count


def _hits(paths: pa.ChunkedArray, patterns: list[str]) -> pa.ChunkedArray:
    """Which paths have one of the patterns in them; null has none."""
    found = pa.chunked_array([pa.array([False] * len(paths), pa.bool_())])
    for pattern in patterns:
        found = pc.or_(found, pc.fill_null(pc.match_substring(paths, pattern), False))
    return found


def removed_rows(
    spark: SparkSession,
    root: str,
    patterns: list[str] = C.REPORT_EXCLUDES,
    edges_only: bool = False,
    partitioned: bool = True,
) -> DataFrame:
    """Per shard file: its size, and rows before, kept and removed. Reads paths only.

    `edges_only` opens only the first and last shard of each subset, which is fast and
    may overlook rows in between.
    """
    root = root.rstrip("/")
    listed = shards(spark, root, partitioned).where(F.col("source") != C.LARGE_SUBSET)
    name = F.element_at(F.split("path", "/"), -1)
    files = listed.select("source", F.concat(F.lit(f"{root}/"), "path").alias("file"), name.alias("name"), F.col("bytes").alias("file_bytes"))
    if edges_only:
        edges = edge_files(files.select("source", F.col("name").alias("file")))
        files = files.join(edges.select("source", F.col("file").alias("name")), ["source", "name"], "left_semi")
    # Paths are a small part of a shard: a task is given a hundred times as many bytes.
    spread = spread_by_bytes(files.withColumn("read", F.ceil(F.col("file_bytes") / 100)), "read", ["file"])
    counted = spread.select("source", "file", "file_bytes").mapInArrow(
        _counter(patterns), "source string, file string, file_bytes bigint, rows_before bigint, rows_removed bigint")
    return counted.select("source", "file", "file_bytes", "rows_before",
                          (F.col("rows_before") - F.col("rows_removed")).alias("rows_kept"), "rows_removed")


def removal_totals(counts: DataFrame) -> DataFrame:
    """Files that lose rows, and rows lost in all."""
    return counts.agg(
        F.count_if(F.col("rows_removed") > 0).alias("files_modified"),
        F.coalesce(F.sum("rows_removed"), F.lit(0).cast("bigint")).alias("total_removed"),
    )


def _rewriter(root: str, patterns: list[str], folder: str):
    """Write each shard without the excluded rows below the folder of a commit."""
    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for source, uri in zip(batch.column("source").to_pylist(), batch.column("file").to_pylist()):
                fs, path = resolve(uri)
                relative = uri[len(root) + 1:]
                target = folder + (relative.split("/", 1)[1] if relative.startswith("_commit-") else relative)
                with fs.open_input_file(path) as handle:
                    shard = pq.ParquetFile(handle)
                    out = ShardFile(root, source, target, shard.schema_arrow)
                    for group in range(shard.num_row_groups):
                        table = shard.read_row_group(group)
                        out.add(table.filter(pc.invert(_hits(table["path"], patterns))))
                        out.flush()
                done.append((relative, *out.publish()))
            columns = list(zip(*done)) or [()] * (len(COMMIT) + 1)
            kinds = [pa.string(), *COMMIT.types]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["old", *COMMIT.names])
    return rewrite


def filter_archive(
    spark: SparkSession,
    root: str,
    patterns: list[str] = C.REPORT_EXCLUDES,
    dry_run: bool = False,
    edges_only: bool = False,
    partitioned: bool = True,
) -> DataFrame:
    """Rewrite the shards holding excluded rows without them; returns the counts per file.

    A first pass over paths finds those shards, so the others are neither read in full
    nor written. Each is rewritten row group by row group next to the archive, without a
    shuffle; then one step publishes them in place of the old ones, so readers see the
    archive with all excluded rows or with none. The old shards stay until `vacuum`. A
    folder without a log gets one. Doing it twice changes nothing.
    """
    root = root.rstrip("/")
    counts = stage(removed_rows(spark, root, patterns, edges_only, partitioned))
    if dry_run:
        return counts
    affected = counts.where("rows_removed > 0").select("source", "file", "file_bytes")
    if affected.isEmpty():
        return counts
    known = versions(root)
    if known is None:
        adopt(spark, root, partitioned)
        known = [1]
    version = known[-1] + 1
    schema = "old string, source string, path string, rows bigint, bytes bigint, schema_hash string"
    spread = spread_by_bytes(affected, "file_bytes", ["file"])
    done = stage(spread.mapInArrow(_rewriter(root, patterns, commit_folder(version)), schema)).toArrow()
    before = committed(root)
    kept = before.filter(pc.invert(pc.is_in(before.column("path"), done.column("old"))))
    publish(root, version, pa.concat_tables([kept, done.drop(["old"]).cast(COMMIT)]))
    return counts


def adopt(spark: SparkSession, root: str, partitioned: bool = True) -> None:
    """Give a folder of shards from elsewhere a log: what lies there is its first version."""
    found = shard_footers(spark, root, partitioned).where(F.col("source") != C.LARGE_SUBSET)
    publish(root, 1, found.select(COMMIT.names).toArrow().cast(COMMIT))
