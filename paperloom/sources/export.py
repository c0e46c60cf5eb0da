"""Writing the bytes of archive rows back to files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.sources.content import spread_by_bytes
from paperloom.sources.storage import AtomicFile, read_from

_RECEIPT = "source string, path string, file_path string, written bigint"


def safe_path(path: Column) -> Column:
    """Is `path` relative and free of `..` segments?"""
    return (
        (path != "")
        & ~path.startswith("/")
        & ~F.exists(F.split(path, "/"), lambda part: part == "..")
    )


def _exporter(out: str):
    def export(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file, written, done = None, None, 0, []
        expected = total = 0

        def close():
            if file:
                if expected != total:
                    raise ValueError(f"{'/'.join(current)}: chunk {expected} of {total} is missing")
                file.publish()
                done.append((*current, file.path, written))

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["source"], row["path"])
                if key != current:
                    close()
                    current, written, expected, total = key, 0, 0, row["total_chunks"]
                    file = AtomicFile(f"{out}/{row['source']}/{row['path']}")
                if row["chunk_index"] != expected:
                    raise ValueError(f"{'/'.join(key)}: chunk {expected} of {total} is missing or repeated")
                expected += 1
                file.write(row["content"])
                written += len(row["content"])
        close()
        columns = list(zip(*done)) or [(), (), (), ()]
        types = [pa.string(), pa.string(), pa.string(), pa.int64()]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
        names = ["source", "path", "file_path", "written"]
        yield pa.RecordBatch.from_arrays(arrays, names)

    return export


def file_export(rows: DataFrame, out: str, receipts: str) -> DataFrame:
    """Write each available file to `out/source/path`; returns what was written.

    Chunks of one file are appended in order by one task; files of a single row stay
    where they are and are not shuffled. Absolute paths and `..` segments fail the job
    before anything is written outside `out`, as do missing or repeated chunks and
    available rows without content. Rows without chunk columns are whole files. The receipts (source, path, file_path,
    written) are a Parquet table at `receipts`, so files are written exactly once.
    """
    checked = F.when(safe_path(F.col("path")) & safe_path(F.col("source")), F.col("path"))
    unsafe = F.raise_error(F.concat(F.lit("unsafe path: "), F.col("source"), F.lit("/"), F.col("path")))
    lost = F.raise_error(F.concat(F.lit("available without content: "), F.col("source"), F.lit("/"), F.col("path")))
    stored = rows.where("content_available").select(
        "source", F.coalesce(checked, unsafe).alias("path"),
        F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"), F.coalesce("total_chunks", F.lit(1)).alias("total_chunks"),
        F.coalesce("content", lost.cast("binary")).alias("content"),
    )
    order = ["source", "path", "chunk_index"]
    chunked = stored.where("total_chunks > 1").repartition("source", "path").sortWithinPartitions(*order)
    whole = stored.where("total_chunks = 1")
    export = _exporter(out.rstrip("/"))
    done = [part.mapInArrow(export, _RECEIPT) for part in (whole, chunked)]
    done[0].unionAll(done[1]).write.mode("overwrite").parquet(receipts)
    return rows.sparkSession.read.schema(_RECEIPT).parquet(receipts)


def _copier(out: str):
    def copy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written = []
            for root, path, repo_path in zip(
                *(batch.column(c).to_pylist() for c in ("root", "path", "repo_path"))
            ):
                target, size = AtomicFile(f"{out}/{repo_path}"), 0
                for piece in read_from(f"{root}/{path}"):
                    target.write(piece)
                    size += len(piece)
                target.publish()
                written.append(size)
            columns = [*batch.select(["source", "path", "repo_path"]).columns, pa.array(written, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["source", "path", "repo_path", "written"])

    return copy


def large_files_publish(files: DataFrame, large: DataFrame, out: str, receipts: str) -> DataFrame:
    """Copy the listed files named by a side table to `out/repo_path`, piece by piece.

    Returns the receipts (source, path, repo_path, written).
    """
    schema = "source string, path string, repo_path string, written bigint"
    chosen = files.join(large.select("source", "path", "repo_path"), ["source", "path"])
    spread = spread_by_bytes(chosen, "file_size", ["source", "path"])
    spread.select("source", "root", "path", "repo_path").mapInArrow(
        _copier(out.rstrip("/")), schema
    ).write.mode("overwrite").parquet(receipts)
    return files.sparkSession.read.schema(schema).parquet(receipts)
