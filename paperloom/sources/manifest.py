"""Manifests (ordered lists of JSON objects) and JSON reports."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.plans.ordering import row_positions
from paperloom.plans.staging import stage
from paperloom.schema import MANIFEST, MANIFEST_ENTRY
from paperloom.sources.listing import list_files
from paperloom.sources.storage import file_size, read_from

# How an indented JSON array ends each of its objects. A JSON string never holds a
# line break, so this text cannot occur inside an entry.
_ENTRY_END = b"\n  }"
_SPLIT_BYTES = 64 << 20


def _split_entries(uri: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(offset, text) of the entries beginning in [start, end)."""
    at = max(0, start - len(_ENTRY_END))
    begin = 0 if start == 0 else None
    held = b""
    for piece in read_from(uri, at):
        held, pos = held + piece, 0
        while (cut := held.find(_ENTRY_END, pos)) >= 0:
            if begin is not None:
                yield begin, held[pos:cut].lstrip(b" \n\r\t,[").decode() + "}"
            pos = cut + len(_ENTRY_END)
            begin = at + pos
            if begin >= end:
                return
        if begin is None:
            # Still before the first entry: keep only what may be the start of its mark.
            pos = max(0, len(held) - len(_ENTRY_END) + 1)
        held, at = held[pos:], at + pos
    if begin is not None and held.strip(b" \n\r\t,[]"):
        raise ValueError(f"{uri}: text that is no entry at {begin}")


def _splitter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        sources, ords, texts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sources), pa.string()), pa.array(list(ords), pa.int64()), pa.array(list(texts), pa.string())],
            ["source", "ord", "text"],
        )

    for ranges in batches:
        rows = []
        names = ("source", "uri", "first", "start", "end")
        for source, uri, first, start, end in zip(*(ranges.column(c).to_pylist() for c in names)):
            for offset, text in _split_entries(uri, start, end):
                rows.append((source, first + offset, text))
                if len(rows) >= 10_000:
                    yield batch(rows)
                    rows = []
        yield batch(rows)


def _is_indented(head: bytes) -> bool:
    """Does a file begin like an array indented by two spaces?"""
    return re.match(rb"\s*\[\r?\n  \{\r?\n", head) is not None


def _layouts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add `indented` to files, from their first bytes."""
    for files in batches:
        heads = (next(iter(read_from(uri, 0, 4096)), b"") for uri in files.column("uri").to_pylist())
        flags = pa.array([_is_indented(head) for head in heads], pa.bool_())
        yield pa.RecordBatch.from_arrays([*files.columns, flags], [*files.schema.names, "indented"])


def _as_array(text: str) -> str:
    """JSON Lines as one array; an array as it is."""
    if text.lstrip().startswith("["):
        return text
    return "[" + ",".join(line for line in text.splitlines() if line.strip()) + "]"


def _wholes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ranges in batches:
        for source, uri, first in zip(*(ranges.column(c).to_pylist() for c in ("source", "uri", "first"))):
            text = _as_array(b"".join(read_from(uri, 0)).decode())
            json.loads(text)  # text that is no JSON fails instead of giving no rows
            yield pa.RecordBatch.from_arrays([pa.array([source]), pa.array([first]), pa.array([text])], ["source", "ord", "text"])


# Entries of the n-th of several manifests have their `ord` from n times this on.
_NEXT_MANIFEST = 1 << 40


def manifest_scan(
    spark: SparkSession, path: str | dict[str, str], indented: bool | None = None, split_bytes: int = _SPLIT_BYTES
) -> DataFrame:
    """A JSON array of entries -> rows (ord, id, path, md5, size); a folder of them, or
    several by `{source: path}` -> the same with `source`.

    The source of a manifest in a folder is its path there. `ord` then counts on from
    manifest to manifest in the order of their sources, so it is unique and increasing.

    Spark's own readers skip names starting with a dot, the usual name of a manifest.
    An array indented by two spaces is read in splits of whole entries, so one large
    file is shared by many tasks; `ord` is then the byte offset of the entry in its file
    (increasing, with gaps). Any other layout, and JSON Lines, is parsed per file and
    suits small files; large ones belong in JSON Lines (`manifest_lines`). The layout is
    told from the first bytes of each file unless `indented` says it.
    """
    several = isinstance(path, dict) or file_size(path) is None
    if isinstance(path, dict):
        named = [(source, uri, file_size(uri)) for source, uri in path.items()]
        files = spark.createDataFrame(named, "source string, uri string, size bigint")
    elif several:
        files = list_files(spark, {"": path}).select(
            F.col("path").alias("source"), F.concat_ws("/", "root", "path").alias("uri"), F.col("file_size").alias("size")
        )
    else:
        files = spark.createDataFrame([("", path, file_size(path))], "source string, uri string, size bigint")
    files = files.withColumn("first", F.lit(0).cast("bigint"))
    if several:
        numbered = row_positions(files.drop("first").withColumn("all", F.lit(0)), ["all"], ["source"], "number")
        files = stage(numbered.select("source", "uri", "size", (F.col("number") * _NEXT_MANIFEST).alias("first")))
    if indented is None:
        schema = "source string, uri string, size bigint, first bigint, indented boolean"
        files = stage(files.mapInArrow(_layouts, schema))
        entries = _split(files.where("indented"), split_bytes).unionByName(_parsed(files.where("not indented")))
    else:
        entries = _split(files, split_bytes) if indented else _parsed(files)
    return entries if several else entries.drop("source")


def _parsed(files: DataFrame) -> DataFrame:
    """Entries of small files, each parsed as a whole."""
    entries = F.from_json("text", f"array<{MANIFEST_ENTRY.simpleString()}>")
    texts = files.select("source", "uri", "first").mapInArrow(_wholes, "source string, ord bigint, text string")
    exploded = texts.select("source", F.col("ord").alias("first"), F.posexplode(entries).alias("ord", "e"))
    return exploded.select("source", (F.col("first") + F.col("ord")).alias("ord"), "e.*")


def _split(files: DataFrame, split_bytes: int) -> DataFrame:
    """Entries of indented arrays, in splits."""
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size"), F.lit(split_bytes).cast("bigint")))
    ranges = files.select("source", "uri", "first", start.alias("start")).select(
        "source", "uri", "first", "start", (F.col("start") + split_bytes).alias("end")
    )
    return (
        ranges.repartition("uri", "start")
        .mapInArrow(_splitter, "source string, ord bigint, text string")
        .select("source", "ord", F.from_json("text", MANIFEST_ENTRY).alias("e"))
        .select("source", "ord", "e.*")
    )


def manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written by manifest_write."""
    return spark.read.schema(MANIFEST).json(path)


def manifest_write(manifest: DataFrame, out: str) -> bool:
    """Write rows as JSON Lines with `ord` kept; an empty manifest writes nothing."""
    if manifest.isEmpty():
        return False
    manifest.write.option("ignoreNullFields", False).json(out)
    return True


def report_write(stats: DataFrame, conflicts: DataFrame, out: str) -> None:
    """Write a dedupe report as JSON Lines below `out`.

    `stats/` holds one object; `conflicts_sample/` one object per (path, md5) of the
    sampled conflicts, because a path may have any number of md5s. Keep `out` outside
    the data root, or the report is archived with the data.
    """
    stats.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{out}/stats")
    conflicts.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{out}/conflicts_sample")
