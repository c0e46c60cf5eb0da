"""Digests of whole files from archive rows that hold them in chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FOLDED = "source string, path string, file_size bigint, md5 string"


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Carry the state of the hash over the chunks of a file, which follow each other."""
    current, state, size, expected, total = None, None, 0, 0, 0

    def closed() -> tuple:
        whole = state is not None and expected == total
        return (*current, size if whole else None, state.hexdigest() if whole else None)

    for batch in batches:
        done = []
        columns = [batch.column(c) for c in ("source", "path", "chunk_index", "total_chunks", "content")]
        for row in zip(*(c.to_pylist() for c in columns[:4]), columns[4]):
            key, index, content = row[:2], row[2], row[4]
            if key != current:
                if current is not None:
                    done.append(closed())
                current, state, size, expected, total = key, hashlib.md5(), 0, 0, row[3]
            if state is None or index != expected or not content.is_valid:
                state = None  # a chunk is missing, there twice, or empty
                continue
            data = content.as_buffer()
            state.update(data)
            size, expected = size + data.size, expected + 1
        yield _rows(done)
    if current is not None:
        yield _rows([closed()])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*done)) or [()] * 4
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["source", "path", "file_size", "md5"])


def file_digests(rows: DataFrame) -> DataFrame:
    """(source, path, file_size, md5) of every file of an archive, as `verify_manifest`
    takes them; both are null for a file whose content is not all there once.

    Files of one row are hashed where they are. Chunks go to the task of their file in
    order, and the task holds a batch of them and the state of the hash, whatever the file's
    size. Rows without content, whose file lies outside the archive, are left out; rows
    without chunk columns are whole files.
    """
    index = F.coalesce("chunk_index", F.lit(0)) if "chunk_index" in rows.columns else F.lit(0)
    total = F.coalesce("total_chunks", F.lit(1)) if "total_chunks" in rows.columns else F.lit(1)
    stored = rows.where("content_available").select(
        "source", "path", index.alias("chunk_index"), total.alias("total_chunks"), "content")
    whole = stored.where("total_chunks = 1").select(
        "source", "path", F.octet_length("content").cast("bigint").alias("file_size"), F.md5("content").alias("md5"))
    order = ["source", "path", "chunk_index"]
    chunked = stored.where("total_chunks > 1").repartition("source", "path").sortWithinPartitions(*order)
    return whole.unionAll(chunked.mapInArrow(_fold, _FOLDED))
