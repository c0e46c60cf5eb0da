"""Bringing bytes to rows: always last, always inside the task that uses them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from paperloom.functions.content import content_location
from paperloom.operators.archive import large_file_join
from paperloom.sources.listing import list_files
from paperloom.sources.storage import read_from, read_range

TASK_BYTES = 256 << 20
_BATCH_BYTES = 32 << 20


def spread_by_bytes(df: DataFrame, size: str, keys: list[str]) -> DataFrame:
    """Repartition metadata rows so that a task is given about TASK_BYTES to read."""
    total = df.agg(F.sum(size)).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return df.repartition(tasks, *keys)


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append `content` and `read_error`, cutting batches by bytes, not by rows."""

    def emit(batch, start, blobs, errors):
        part = batch.slice(start, len(blobs))
        arrays = [*part.columns, pa.array(blobs, pa.binary()), pa.array(errors, pa.string())]
        names = [*batch.schema.names, "content", "read_error"]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        wanted = zip(
            *(batch.column(c).to_pylist() for c in ("root", "path", "offset", "nbytes"))
        )
        start, held, blobs, errors = 0, 0, [], []
        for position, (root, path, offset, nbytes) in enumerate(wanted):
            try:
                blob = None if nbytes is None else read_range(f"{root}/{path}", offset, nbytes)
                errors.append(None)
            except OSError as exc:
                blob = None
                errors.append(str(exc))
            blobs.append(blob)
            held += len(blob or b"")
            if held >= _BATCH_BYTES:
                yield emit(batch, start, blobs, errors)
                start, held, blobs, errors = position + 1, 0, [], []
        if blobs:
            yield emit(batch, start, blobs, errors)


def attach_content(located: DataFrame) -> DataFrame:
    """Add `content` and `read_error` to rows with root, path, offset and nbytes.

    Rows whose nbytes is null (kept outside the archive) get no content. A file that
    cannot be read costs only its own rows.
    """
    out = StructType([
        *located.schema.fields,
        StructField("content", BinaryType()),
        StructField("read_error", StringType()),
    ])
    return located.mapInArrow(_reader, out)


def load_content(
    rows: DataFrame, large: DataFrame, repo_root: str, chunk_bytes: int = 64 << 20
) -> DataFrame:
    """The bytes of archive rows wherever they are kept: embedded, or below `repo_root`.

    Returns (source, path, chunk_index, location, content, read_error). External files
    are read in chunks by the tasks; restrict `rows` first to read only what is needed.
    """
    inside = F.coalesce("content_available", F.lit(False))
    shown = ["source", "path", "chunk_index", "location", "content", "read_error"]
    none = F.lit(None)
    embedded = rows.where(inside).withColumns({"location": F.lit("embedded"), "read_error": none.cast("string")})
    # Content never meets the side table: only rows without any are joined.
    joined = large_file_join(rows.where(~inside).drop("content"), large).withColumn(
        "location", content_location(F.lit(False), F.col("repo_path"))
    )
    lost = joined.where("location <> 'external'").withColumns(
        {"content": none.cast("binary"), "read_error": F.lit("content not available")})
    kept = embedded.select(shown).unionAll(lost.select(shown))
    start = F.col("chunk_index").cast("bigint") * F.lit(chunk_bytes)
    chunks = F.greatest(F.ceil(F.col("file_size") / F.lit(chunk_bytes)).cast("int"), F.lit(1))
    located = (
        joined.where("location = 'external'")
        .withColumn("chunk_index", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(
            "source", F.col("path").alias("archive_path"), "chunk_index", "location",
            F.lit(repo_root.rstrip("/")).alias("root"),
            F.col("repo_path").alias("path"),
            start.alias("offset"),
            F.least(F.lit(chunk_bytes), F.col("file_size") - start).alias("nbytes"),
        )
    )
    read = attach_content(located).withColumn("path", F.col("archive_path"))
    return kept.unionAll(read.select(shown))


def _digester(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for root, path in zip(batch.column("root").to_pylist(), batch.column("path").to_pylist()):
            digest = hashlib.md5(usedforsecurity=False)
            try:
                for piece in read_from(f"{root}/{path}"):
                    digest.update(piece)
                digests.append(digest.hexdigest())
            except OSError:
                digests.append(None)
        arrays = [*batch.columns, pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "md5"])


def with_file_md5(files: DataFrame) -> DataFrame:
    """Add the md5 of each whole file; bytes are digested where read and never kept."""
    out = StructType([*files.schema.fields, StructField("md5", StringType())])
    return files.mapInArrow(_digester, out)


def files_on_disk(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files below each root with the md5 of their bytes, as verify_manifest expects them."""
    listed = list_files(spark, roots)
    return with_file_md5(spread_by_bytes(listed, "file_size", ["source", "path"]))
