"""WARC archives and their Merkle fixity audit.

Every record is hashed together with the byte range it fills in its archive. FANOUT hashes
in order make one of the level above, up to a root per archive. Replicas are compared
from the roots down: only the children of nodes that differ are looked at, so the work of
a comparison follows the damage, not the archive.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.llm.staging import staged
from paperloom.plans.ordering import row_positions
from paperloom.sources.content import spread_by_bytes
from paperloom.sources.listing import list_files
from paperloom.sources.storage import AtomicFile, read_from

FANOUT = 16
#: Records of an archive.
RECORDS = 1000
#: Ranges of archives that records are sent to; the first key of each is broadcast.
MAX_RANGES = 65_536
_ORDER = ["id", "digest", "row"]
BREAK = "\r\n\r\n"
_BREAK = BREAK.encode()
_NEXT = _BREAK + b"WARC/1."
_LENGTH = re.compile(rb"\r\nContent-Length: (\d{1,18})$")
_BATCH_BYTES = 8 << 20
#: Files are archive-n.warc.gz; all places are those of the bytes before compression.
FILE = r"^archive-\d+\.warc\.gz$"
_GZIP = 31
#: The default level takes 2.5 times the seconds for archives 4 % smaller.
_LEVEL = 4


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    date: str = "1970-01-01T00:00:00Z", per_archive: int = RECORDS,
) -> DataFrame:
    """(archive, ordinal, id, record, start, length) of every page: the bytes of a WARC
    record, the archive it belongs to, and the range it fills there with the break behind it.

    Records are in order of id and SHA-256 of the record over all archives, each of which
    but the last has `per_archive` of them, whatever the ids. Null urls and bodies are
    empty, null ids come first; repeated rows are records of their own. An empty table has
    no archives. Other columns are ignored.

    Records move once, to their archive, whose first key they find in a broadcast: one of
    about 100 bytes per archive, or beyond MAX_RANGES archives one per run of several.
    """
    page = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(body_col), F.lit("")).alias("body"))
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), "url"))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
                       F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "")), F.lit(f"WARC-Date: {date}"),
                       F.lit("Content-Type: text/html"), F.concat(F.lit("Content-Length: "), F.octet_length("body").cast("string")))
    record = F.concat(head, F.lit(BREAK), "body").cast("binary")
    made = page.select(F.monotonically_increasing_id().alias("row"), "id", record.alias("record"))
    rows = staged(made.select("row", "id", F.sha2("record", 256).alias("digest"),
                              (F.octet_length("record") + len(BREAK)).cast("long").alias("length"), "record"), "records")
    # Only keys are sorted over all archives; records find theirs by its first key and move once.
    every = -(-rows.count() // (per_archive * MAX_RANGES)) or 1
    at = row_positions(rows.select("row", "id", "digest", F.lit("").alias("all")), ["all"], _ORDER, "at")
    firsts = sorted((r["id"] is not None, r["id"] or 0, r["digest"], r["row"])
                    for r in at.where(F.col("at") % (per_archive * every) == 0).select(_ORDER).collect())
    shared = pages.sparkSession.sparkContext.broadcast(firsts)
    within = "archive" if every == 1 else "range"
    found = rows.withColumn(within, _finder(shared)(F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), "digest", "row"))
    ordinal = F.row_number().over(Window.partitionBy(within).orderBy(*_ORDER)).cast("long") - 1
    if every == 1:
        placed = found.withColumn("ordinal", ordinal)
    else:
        placed = found.withColumn("at", ordinal).withColumns({
            "archive": F.col("range") * every + F.expr(f"at div {per_archive}"), "ordinal": F.col("at") % per_archive})
    before = Window.partitionBy(*{within: 0, "archive": 0}).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum("length").over(before) - F.col("length")
    return placed.withColumn("start", start).select("archive", "ordinal", "id", "record", "start", "length")


def _finder(shared: Broadcast):
    """The number of the range of archives that a key lies in, by the first keys of all."""
    @F.pandas_udf("long")
    def find(known: pd.Series, id_: pd.Series, digest: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([bisect(shared.value, key) - 1 for key in zip(known, id_, digest, row)], dtype="int64")
    return find


class _Compressed:
    """A file that appears under its name when it is complete, gzip around what is written."""

    def __init__(self, uri: str):
        self.file, self.gzip = AtomicFile(uri), zlib.compressobj(_LEVEL, wbits=_GZIP)

    def write(self, data: bytes) -> None:
        self.file.write(self.gzip.compress(data))

    def publish(self) -> None:
        self.file.write(self.gzip.flush())
        self.file.publish()


def _inflated(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of a compressed file in pieces of bounded size, up to where it cannot be
    decompressed any more."""
    gzip = zlib.decompressobj(wbits=_GZIP)
    for piece in pieces:
        while piece:
            try:
                yield gzip.decompress(piece, _BATCH_BYTES)
            except zlib.error:
                return
            piece = gzip.unconsumed_tail
            if gzip.eof and gzip.unused_data:
                piece, gzip = gzip.unused_data, zlib.decompressobj(wbits=_GZIP)
    yield gzip.flush()


def _writer(path: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file, written, count, done = None, None, 0, 0, []
        for batch in batches:
            for archive, record, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if archive != current:
                    if file:
                        file.publish()
                        done.append((current, written))
                    current, file, written, count = archive, _Compressed(f"{path}/archive-{archive:010d}.warc.gz"), 0, 0
                count += 1
                if n != count:
                    raise ValueError(f"archive {archive}: record {n} where {count} should be")
                data = record.as_py() + _BREAK
                file.write(data)
                written += len(data)
        if file:
            file.publish()
            done.append((current, written))
        yield pa.record_batch([pa.array([d[i] for d in done], pa.int64()) for i in (0, 1)], ["archive", "bytes"])
    return write


def write_warc(records_: DataFrame, path: str) -> DataFrame:
    """Write one file archive-n.warc.gz per archive below `path`; returns (archive, bytes),
    the bytes before compression.

    A file appears under its name when it is complete, so a task that is repeated after a
    lost executor replaces it with the same bytes. Memory holds a batch of records.
    """
    # Numbered instead of dealt out: records that lie by archive, as `records` leaves them, stay where they are.
    n = F.row_number().over(Window.partitionBy("archive").orderBy("ordinal"))
    dealt = records_.select("archive", "ordinal", "record").withColumn("n", n).select("archive", "record", "n")
    return staged(dealt.mapInArrow(_writer(path.rstrip("/")), "archive long, bytes long"), "written")


def _split(pieces: Iterable[bytes]) -> Iterator[tuple[bytes, int, int]]:
    """(record, start, length) of the records of a file that comes in pieces.

    A record ends where its Content-Length says if a break follows there. If not, or without
    a length, it ends at the next break before a WARC version line, or with the file: damage
    costs the record it hits and none behind it. Memory holds the record and a piece.
    """
    pieces, data, start, ended = filter(None, pieces), bytearray(), 0, False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        data.extend(piece or b"")
        return not ended

    def find(what: bytes, at: int) -> int:
        while (found := data.find(what, at)) < 0 and not ended:
            at = max(at, len(data) - len(what) + 1)
            more()
        return found

    while data or more():
        head = find(_BREAK, 0)
        stated = _LENGTH.search(bytes(data[:head])) if head >= 0 else None
        end = -1
        if stated:
            end = head + len(_BREAK) + int(stated[1])
            while len(data) < end + len(_BREAK) and not ended:
                more()
            if data[end:end + len(_BREAK)] != _BREAK:
                end = -1
        if end < 0:
            end = find(_NEXT, max(head, 0))
        if end < 0:
            end = len(data) - (len(_BREAK) if data.endswith(_BREAK) else 0)
        stop = min(end + len(_BREAK), len(data))
        yield bytes(data[:end]), start, stop
        del data[:stop]
        start += stop


def _reader(path: str):
    names = ["archive", "ordinal", "record", "start", "length"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                for ordinal, (record, start, length) in enumerate(_split(_inflated(read_from(f"{path}/{name}")))):
                    rows.append((archive, ordinal, record, start, length))
                    held += length
                    if held >= _BATCH_BYTES:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return read


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(archive, ordinal, record, start, length) of the bytes in a folder of WARC files, as
    they are there: see `_split` for damaged ones. What cannot be decompressed ends its file,
    so the records behind are missing. An empty file has no records."""
    files = list_files(spark, {"": path}).where(F.col("path").rlike(FILE))
    spread = spread_by_bytes(files, "file_size", ["path"])
    named = spread.select(F.regexp_extract("path", r"(\d+)", 1).cast("long").alias("archive"), "path")
    return named.mapInArrow(_reader(path.rstrip("/")), "archive long, ordinal long, record binary, start long, length long")


def _splicer(source: str, target: str):
    def splice(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, edits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file, at, pending = _Compressed(f"{target}/{name}"), 0, [(e["at"], e["drop"], e["put"]) for e in edits or []]
                skip = 0
                for piece in _inflated(read_from(f"{source}/{name}")):
                    begin, stop = 0, len(piece)
                    while True:
                        gone = min(skip, stop - begin)
                        begin, skip = begin + gone, skip - gone
                        while pending and pending[0][0] < at + begin:  # inside what went already
                            pending.pop(0)
                        if not pending or pending[0][0] >= at + stop:
                            break
                        place, skip, put = pending.pop(0)
                        file.write(piece[begin:place - at] + put)
                        begin = place - at
                    file.write(piece[begin:])
                    at += stop
                file.publish()
            yield batch.select(["path"])
    return splice


def copy_spliced(spark: SparkSession, source: str, target: str, edits: DataFrame) -> DataFrame:
    """Copy the archives of a folder with `edits` (archive, at, drop, put): `drop` bytes at
    the place `at` go and the bytes `put` come there. Edits within what an earlier one
    dropped do nothing. Returns the (path) of each copy; without edits a copy is exact."""
    files = list_files(spark, {"": source}).where(F.col("path").rlike(FILE))
    listed = edits.groupBy("archive").agg(F.array_sort(F.collect_list(F.struct("at", "drop", "put"))).alias("edits"))
    named = files.withColumn("archive", F.regexp_extract("path", r"(\d+)", 1).cast("long")).join(listed, "archive", "left")
    return staged(spread_by_bytes(named, "file_size", ["path"]).select("path", "edits").mapInArrow(
        _splicer(source.rstrip("/"), target.rstrip("/")), "path string"), "spliced")


def tree(records_: DataFrame) -> list[DataFrame]:
    """Levels of the Merkle trees of all archives, leaves first: (archive, node, hash, start, stop).

    A leaf hashes its byte range and the SHA-256 of the record; an inner node hashes the
    hashes of its children in order, FANOUT at most.
    """
    digest = F.sha2("record", 256)
    leaf = F.sha2(F.concat_ws(":", F.col("start").cast("string"), F.col("length").cast("string"), digest), 256)
    level = staged(records_.select("archive", F.col("ordinal").alias("node"), leaf.alias("hash"), "start",
                                   (F.col("start") + F.col("length")).alias("stop"), digest.alias("digest")), "merkle")
    levels = [level]
    while not level.where("node > 0").isEmpty():
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        level = staged(level.groupBy("archive", F.expr(f"node div {FANOUT}").alias("parent")).agg(
            F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), "|"), 256).alias("hash"),
            F.min("start").alias("start"), F.max("stop").alias("stop")).withColumnRenamed("parent", "node"), "merkle")
        levels.append(level)
    return levels


def differences(ours: list[DataFrame], theirs: list[DataFrame]) -> DataFrame:
    """Damaged byte ranges of a replica: (archive, ordinal, fault, start, stop, expected, found).

    fault is changed, moved (the same record in another range), missing or surplus; start
    and stop are our range, or theirs if surplus; expected and found are the digests of the records. Trees of different height
    are compared from the lower root.
    """
    bad = None
    for k in reversed(range(min(len(ours), len(theirs)))):
        sides = []
        for side, name in ((ours[k], "a"), (theirs[k], "b")):
            if bad is not None:
                side = side.join(bad, (side["archive"] == bad["in_archive"]) & (F.expr(f"node div {FANOUT}") == bad["in_node"]), "left_semi")
            sides.append(side.select([F.col(c).alias(f"{name}_{c}") for c in side.columns]))
        met = sides[0].join(sides[1], (F.col("a_archive") == F.col("b_archive")) & (F.col("a_node") == F.col("b_node")), "full")
        met = met.where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
        if k:
            bad = staged(met.select(F.coalesce("a_archive", "b_archive").alias("in_archive"), F.coalesce("a_node", "b_node").alias("in_node")), "differ")
    fault = F.when(F.col("a_node").isNull(), "surplus").when(F.col("b_node").isNull(), "missing").when(
        F.col("a_digest") == F.col("b_digest"), "moved").otherwise("changed")
    return met.select(
        F.coalesce("a_archive", "b_archive").alias("archive"), F.coalesce("a_node", "b_node").alias("ordinal"), fault.alias("fault"),
        F.coalesce("a_start", "b_start").alias("start"), F.coalesce("a_stop", "b_stop").alias("stop"),
        F.col("a_digest").alias("expected"), F.col("b_digest").alias("found"))


def audit(records_: DataFrame, replica: DataFrame) -> DataFrame:
    """Compare a replica's records with ours and locate what differs: see `differences`.
    Archives that only one side has are missing or surplus as a whole; two empty sides agree."""
    return differences(tree(records_), tree(replica))
