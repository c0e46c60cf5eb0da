"""Operators over archive tables and the large-file side table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.content import chunk_count, content_location
from paperloom.functions.paths import size_gb, size_mb


def content_chunks(
    rows: DataFrame, max_bytes: int = C.MAX_FILE_BYTES, chunk_bytes: int = C.CHUNK_BYTES
) -> DataFrame:
    """Split the content of whole-file rows above `max_bytes` into chunk rows."""
    first = F.col("chunk_index") * F.lit(chunk_bytes) + 1
    piece = F.substring(F.col("content"), first, F.lit(chunk_bytes))
    return (
        rows.withColumn("total_chunks", chunk_count(F.col("file_size"), max_bytes, chunk_bytes))
        .withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
        .withColumn("content", F.when(F.col("total_chunks") > 1, piece).otherwise(F.col("content")))
    )


def large_files_build(files: DataFrame, max_bytes: int = C.MAX_FILE_BYTES) -> DataFrame:
    """The side table of files too large to embed.

    `repo_path` keeps source and path, so that files of one name do not collide, and
    `file_id` is derived from them, so that it is stable.
    """
    name = F.concat_ws("/", "source", "path")
    return files.where(F.col("file_size") > max_bytes).select(
        F.md5(name).alias("file_id"),
        "source", "path", "file_size", "extension", "file_type",
        F.concat(F.lit(C.LARGE_PREFIX), name).alias("repo_path"),
        F.lit(False).alias("content_available"),
    )


def large_file_join(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Archive rows with file_id and repo_path of their side-table entry, if any.

    No broadcast hint: adaptive execution measures the side table and broadcasts it
    while it is small.
    """
    return rows.join(large.select("source", "path", "file_id", "repo_path"), ["source", "path"], "left")


def content_resolve(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Where the bytes of each row are: location, repo_path, and size in MB and GB."""
    size = F.col("file_size")
    return large_file_join(rows, large).select(
        "source", "path", "file_size",
        content_location(F.col("content_available"), F.col("repo_path")).alias("location"),
        F.when(~F.col("content_available"), F.col("repo_path")).alias("repo_path"),
        size_mb(size).alias("size_mb"),
        size_gb(size).alias("size_gb"),
    )


def source_priority_resolve(included: DataFrame, existing: DataFrame, roots: DataFrame) -> DataFrame:
    """For each included name the root of highest priority (lowest number) holding it.

    `included(name)`, `existing(root, name)`, `roots(root, priority)`; names found
    nowhere are left out.
    """
    return (
        existing.join(roots, "root")
        .join(included.select("name").distinct(), "name", "left_semi")
        .groupBy("name")
        .agg(F.min(F.struct("priority", "root")).alias("best"))
        .select("name", "best.root", "best.priority")
    )


def concat_subsets(subsets: list[DataFrame]) -> DataFrame:
    """All rows of all subsets, repeats kept."""
    return reduce(DataFrame.unionByName, subsets)


def train_eval_split(rows: DataFrame, splits: dict[str, list[str]]) -> DataFrame:
    """Add `split`: the name whose list holds the row's source; other rows are dropped."""
    label: Column = F
    for name, sources in splits.items():
        label = label.when(F.col("source").isin(sources), name)
    wanted = [s for sources in splits.values() for s in sources]
    return rows.where(F.col("source").isin(wanted)).withColumn("split", label)


# Summaries. Grouping columns have few values; partial aggregation reduces each task's
# rows to one per value before the shuffle, so one dominating source is no burden.


def count_by_source(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("files")).orderBy("source")


def archive_summary(rows: DataFrame, plan: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Per source: files, bytes, files in several chunks, and shards of a shard plan.

    With `failures` (rows that were skipped because they could not be read: source, path,
    ...) files count only if all of them was read, and the others as `failed_files`.
    """
    firsts = rows.where("chunk_index = 0 or chunk_index is null").select("source", "path", "file_size", "total_chunks")
    read = F.lit(True)
    if failures is not None:
        failed = failures.select("source", "path").distinct().withColumn("failed", F.lit(True))
        firsts = firsts.join(failed, ["source", "path"], "left")
        read = F.col("failed").isNull()
    files = firsts.groupBy("source").agg(
        F.count_if(read).alias("files"),
        F.coalesce(F.sum(F.when(read, F.col("file_size"))), F.lit(0).cast("bigint")).alias("bytes"),
        F.count_if(read & (F.col("total_chunks") > 1)).alias("chunked_files"),
        *([F.count_if(~read).alias("failed_files")] if failures is not None else []),
    )
    return files.join(shard_totals(plan), "source", "left")


def shard_totals(plan: DataFrame) -> DataFrame:
    """Shards per source of a shard plan."""
    return plan.groupBy("source").agg((F.max("shard") + 1).cast("bigint").alias("shards"))


def embedded_vs_external(rows: DataFrame) -> DataFrame:
    """Counts and bytes of embedded and external files."""
    embedded, external = F.col("content_available"), F.col("external_file").isNotNull()

    def size_where(kind: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind, F.col("file_size"))), F.lit(0).cast("bigint"))

    return rows.agg(
        F.count("*").alias("files"),
        F.count_if(embedded).alias("embedded_files"),
        F.count_if(external).alias("external_files"),
        size_where(embedded).alias("embedded_bytes"),
        size_where(external).alias("external_bytes"),
    )


def subset_sizes(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Files and bytes per subset, the side table being a subset of its own."""
    side = large.select(F.lit(C.LARGE_SUBSET).alias("subset"), "file_size")
    return (
        rows.select(F.col("source").alias("subset"), "file_size")
        .unionAll(side)
        .groupBy("subset")
        .agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))
    )


def archive_rollup(rows: DataFrame) -> DataFrame:
    """Files, bytes and GB per source, with a grand total (source null)."""
    return rows.rollup("source").agg(
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
        size_gb(F.sum("file_size")).alias("size_gb"),
    )


def modality_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("file_type").agg(F.count("*").alias("files"))


def edge_files(shards: DataFrame) -> DataFrame:
    """First and last shard by name in each subset: (source, file) rows."""
    ends = shards.groupBy("source").agg(F.min("file").alias("a"), F.max("file").alias("b"))
    return ends.select("source", F.explode(F.array_distinct(F.array("a", "b"))).alias("file"))
