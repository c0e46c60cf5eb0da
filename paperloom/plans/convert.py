"""From named folders to an archive in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.operators.archive import archive_summary, source_priority_resolve
from paperloom.sources.archive import plan_rows
from paperloom.sources.listing import list_files
from paperloom.sources.shards import archive_write, read_failures
from paperloom.sources.storage import list_dir


def find_sources(spark: SparkSession, include: list[str], roots: list[str]) -> DataFrame:
    """(name, root, priority): the first of `roots` that has a folder of each name."""
    existing = [(root, e.name) for root in roots for e in list_dir(root) if e.is_dir]
    return source_priority_resolve(
        spark.createDataFrame([(name,) for name in include], "name string"),
        spark.createDataFrame(existing, "root string, name string"),
        spark.createDataFrame([(r, i) for i, r in enumerate(roots)], "root string, priority int"),
    )


def convert(
    spark: SparkSession,
    include: list[str],
    roots: list[str],
    out: str,
    exclude: list[str] = C.PUBLISH_EXCLUDES,
    large: str = "chunk",
    max_shard_bytes: int = C.MAX_SHARD_BYTES,
    partitioned: bool = True,
    on_error: str = "fail",
) -> DataFrame:
    """Write the included folders as one archive below `out`.

    Returns (source, files, bytes, chunked_files, shards), with a row of zeros for a
    folder without files. Names found under no root are left out. A file that cannot be
    read fails the job; with `on_error="skip"` it does not count, but as one of `failed_files`.
    """
    found = find_sources(spark, include, roots).collect()
    sources = {r.name: f"{r.root.rstrip('/')}/{r.name}" for r in found}
    if not sources:
        raise FileNotFoundError(f"none of {include} below {roots}")
    rows = plan_rows(list_files(spark, sources), exclude, large)
    plan = archive_write(rows, out, max_shard_bytes, partitioned, on_error)
    names = spark.createDataFrame([(name,) for name in sources], "source string")
    failures = read_failures(spark, out) if on_error == "skip" else None
    return names.join(archive_summary(rows, plan, failures), "source", "left").select(
        "source",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("files", "bytes", "chunked_files", *["failed_files"] * (failures is not None), "shards")],
    )
