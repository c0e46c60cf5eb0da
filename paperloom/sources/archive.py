"""Archive rows from file trees, and archives on disk back to rows."""

from __future__ import annotations

from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.content import chunk_count
from paperloom.functions.paths import file_extension, file_type, matches_none
from paperloom.schema import ARCHIVE, LARGE_FILES
from paperloom.sources.commits import committed, shards, versions
from paperloom.sources.content import attach_content, spread_by_bytes
from paperloom.sources.listing import list_files
from paperloom.sources.storage import list_dir

# Row sizes that suit rows passing through the JVM; the shard writer reads bytes
# itself and keeps the larger fixed values.
SCAN_ROW_BYTES = 64 << 20

# How attach_content and the shard writer find the bytes of a row.
LOCATION = ["root", "offset", "nbytes"]


def plan_rows(
    files: DataFrame,
    exclude: list[str] = C.CONVERT_EXCLUDES,
    large: str = "chunk",
    max_bytes: int = C.MAX_FILE_BYTES,
    chunk_bytes: int = C.CHUNK_BYTES,
    row_bytes: int | None = None,
) -> DataFrame:
    """Metadata of the archive rows of listed files: no byte is read yet.

    A file above `max_bytes` becomes several chunk rows (`large="chunk"`) or one row
    without content (`large="external"`), whose bytes stay outside the archive. Content
    above `row_bytes` (default `max_bytes`) is cut into chunks as well.
    """
    if large not in ("chunk", "external"):
        raise ValueError(f"large must be 'chunk' or 'external', not {large!r}")
    extension = F.col("extension")
    kept = (
        files.where(matches_none(F.col("path"), exclude))
        .withColumn("extension", file_extension(F.col("path")))
        .withColumn("file_type", file_type(extension))
    )
    size = F.col("file_size")
    outside = (size > max_bytes) if large == "external" else F.lit(False)
    chunks = F.when(outside, 1).otherwise(chunk_count(size, min(row_bytes or max_bytes, max_bytes), chunk_bytes))
    start = F.col("chunk_index").cast("bigint") * F.lit(chunk_bytes)
    length = F.when(F.col("total_chunks") == 1, size).otherwise(
        F.least(F.lit(chunk_bytes), size - start)
    )
    return (
        kept.withColumn("total_chunks", chunks)
        .withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
        .select(
            "path", "source", "file_type", "file_size", "extension",
            (~outside).alias("content_available"),
            "chunk_index", "total_chunks", "root",
            start.alias("offset"),
            F.when(~outside, length).cast("bigint").alias("nbytes"),
        )
    )


def archive_scan(
    spark: SparkSession,
    roots: dict[str, str],
    exclude: list[str] = C.CONVERT_EXCLUDES,
    large: str = "chunk",
    max_bytes: int = C.MAX_FILE_BYTES,
    chunk_bytes: int = SCAN_ROW_BYTES,
    row_bytes: int = SCAN_ROW_BYTES,
) -> DataFrame:
    """File trees -> archive rows with content, plus `read_error` (null when read).

    `max_bytes` decides which files are external, as everywhere; `row_bytes` only how
    content is cut. A row whose bytes could not be read is not available.
    """
    rows = plan_rows(list_files(spark, roots), exclude, large, max_bytes, chunk_bytes, row_bytes)
    spread = spread_by_bytes(rows, "nbytes", ["source", "path", "chunk_index"])
    read = attach_content(spread).withColumn(
        "content_available", F.col("content_available") & F.col("read_error").isNull()
    )
    return read.select(*ARCHIVE.fieldNames(), "read_error")


def scan_shards(
    spark: SparkSession, root: str, partitioned: bool = True, source: str | None = None, version: int | None = None
) -> DataFrame:
    """Rows of the shards of an archive, or of one subset.

    What belongs to an archive is what its log says (`commits`): the newest version, or
    the given one. Folders without a log, from elsewhere, are read as they are.

    `source` is the partition column of `source=name` folders. Archives with plain
    `name` folders (`partitioned=False`) keep it in their rows. The side table of large
    files next to the subsets is left out.
    """
    root, reader = root.rstrip("/"), spark.read.schema(ARCHIVE)
    table = committed(root, version)
    if table is None:
        return _scan_folders(reader, root, partitioned, source)
    if source is not None:
        table = table.filter(pc.equal(table.column("source"), source))
    folders: dict[str, list[str]] = {}
    for path in table.column("path").to_pylist():
        folders.setdefault(path.split("/", 1)[0] if path.startswith("_commit-") else "", []).append(f"{root}/{path}")
    if not folders:
        return spark.createDataFrame([], ARCHIVE)
    if not partitioned:  # no name of a folder is a partition
        return reader.option("recursiveFileLookup", True).parquet(*[p for paths in folders.values() for p in paths]).select(ARCHIVE.fieldNames())
    parts = [
        spark.read.schema(ARCHIVE).option("basePath", f"{root}/{folder}").parquet(*_as_folders(paths)).select(ARCHIVE.fieldNames())
        for folder, paths in folders.items()
    ]
    rows = reduce(DataFrame.unionAll, parts)
    return rows if source is None else rows.where(F.col("source") == source)


def _as_folders(paths: list[str]) -> list[str]:
    """The folders of shards instead of the shards, where a folder holds nothing else: Spark
    looks for every path it is given, and lists each in a task of its own."""
    names: dict[str, set[str]] = {}
    for path in paths:
        parent, _, name = path.rpartition("/")
        names.setdefault(parent, set()).add(name)
    found = []
    for parent, wanted in names.items():
        there = {e.name for e in list_dir(parent) if not e.name.startswith(("_", "."))}
        found += [parent] if there == wanted else [f"{parent}/{name}" for name in sorted(wanted)]
    return found


def _scan_folders(reader: DataFrameReader, root: str, partitioned: bool, source: str | None) -> DataFrame:
    if not partitioned and source is not None:
        return reader.parquet(f"{root}/{source}")
    if partitioned:
        rows = reader.option("basePath", root).parquet(f"{root}/source=*")
    else:
        in_side_table = F.contains("_metadata.file_path", F.lit(f"/{C.LARGE_SUBSET}/"))
        rows = reader.parquet(root, recursiveFileLookup=True).where(~in_side_table)
    rows = rows.select(ARCHIVE.fieldNames())
    return rows if source is None else rows.where(F.col("source") == source)


def read_archive(spark: SparkSession, root: str, partitioned: bool = True, version: int | None = None) -> DataFrame:
    """All subsets of an archive as archive rows."""
    return scan_shards(spark, root, partitioned, version=version)


def subset_scan(spark: SparkSession, root: str, source: str, partitioned: bool = True) -> DataFrame:
    """One subset; only its shards are read."""
    return scan_shards(spark, root, partitioned, source)


def large_files_write(large: DataFrame, root: str) -> None:
    """Write the side table next to the subsets of an archive."""
    large.write.parquet(f"{root}/{C.LARGE_SUBSET}")


def large_files_scan(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(LARGE_FILES).parquet(f"{root}/{C.LARGE_SUBSET}")


def all_subsets_scan(
    spark: SparkSession, root: str, partitioned: bool = True
) -> dict[str, DataFrame]:
    """Every subset by name, the side table included, each a lazy DataFrame.

    The subsets share one scan of the archive, restricted to their partition.
    """
    names = sorted(r.source for r in discover_subsets(spark, root).select("source").collect())
    rows = read_archive(spark, root, partitioned) if any(n != C.LARGE_SUBSET for n in names) else None
    return {
        name: large_files_scan(spark, root) if name == C.LARGE_SUBSET else rows.where(F.col("source") == name)
        for name in names
    }


def discover_subsets(spark: SparkSession, root: str) -> DataFrame:
    """Subsets with at least one shard: (source, pattern, shards). The pattern has the
    shards of the folder that the subset's newest shards lie in."""
    root = root.rstrip("/")
    listed = shards(spark, root)
    if versions(root):  # the side table is no part of the log
        side = list_files(spark, {"": root}).where(F.startswith("path", F.lit(f"{C.LARGE_SUBSET}/")) & F.endswith("path", F.lit(".parquet")))
        listed = listed.unionAll(side.select(F.lit(C.LARGE_SUBSET), "path", "file_size"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return listed.groupBy("source").agg(
        F.concat(F.lit(f"{root}/"), F.max(folder), F.lit("/*.parquet")).alias("pattern"), F.count("*").alias("shards"))
