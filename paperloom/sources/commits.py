"""Which shards make up an archive.

A write publishes a commit: a table in the folder `_log` that names every shard of the
archive from then on, with its rows, bytes and schema. It appears under its name by one
rename, so readers see the archive before a write or after it, never in between. Shards
that a later commit replaces stay on disk until `vacuum`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.sources.listing import list_files
from paperloom.sources.storage import AtomicFile, list_dir, resolve

LOG = "_log"
_BEGUN = "begun"
_SUFFIX = ".commit"
COMMIT = pa.schema([
    ("source", pa.string()), ("path", pa.string()), ("rows", pa.int64()), ("bytes", pa.int64()), ("schema_hash", pa.string()),
])


class Shard(NamedTuple):
    """A shard file: its path below the archive, the folder of its commit included."""

    source: str
    path: str
    rows: int
    bytes: int
    schema_hash: str


def schema_hash(schema: pa.Schema) -> str:
    """Equal for shards with the same columns and types in the same order."""
    return hashlib.md5("\n".join(f"{f.name} {f.type}" for f in schema).encode()).hexdigest()


def versions(root: str) -> list[int] | None:
    """Published versions in order; null for a folder without a log."""
    try:
        names = [e.name for e in list_dir(f"{root}/{LOG}")]
    except (FileNotFoundError, NotADirectoryError):
        return None
    return sorted(int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX))


def begin(root: str) -> None:
    """From now on only published shards of the folder are read."""
    AtomicFile(f"{root}/{LOG}/{_BEGUN}").publish()


def commit_folder(version: int) -> str:
    """Where the shards of a commit lie; the first one's lie in the archive itself."""
    return "" if version == 1 else f"_commit-{version:08d}/"


def publish(root: str, version: int, shards: Iterable[Shard] | pa.Table) -> None:
    """Make the shards the content of the archive. One writer at a time may publish."""
    if version in (versions(root) or []):
        raise FileExistsError(f"{root} has a version {version}: another writer was faster")
    if not isinstance(shards, pa.Table):
        columns = list(zip(*shards)) or [()] * len(COMMIT)
        shards = pa.table([pa.array(c, f.type) for c, f in zip(columns, COMMIT)], schema=COMMIT)
    file = AtomicFile(f"{root}/{LOG}/{version:08d}{_SUFFIX}")
    pq.write_table(shards.sort_by("path"), file.stream)
    file.publish()


def committed(root: str, version: int | None = None) -> pa.Table | None:
    """Shards of the newest or the given version; null for a folder without a log.

    The names of all shards are on the driver here, as they are in the file index of any
    scan. An archive whose first write did not finish does not exist.
    """
    known = versions(root)
    if known is None:
        return None
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{root}: " + (f"no version {version}" if known else "the archive was never written to the end"))
    fs, path = resolve(f"{root}/{LOG}/{version or known[-1]:08d}{_SUFFIX}")
    with fs.open_input_file(path) as handle:
        return pq.read_table(handle, schema=COMMIT)


def shards(spark: SparkSession, root: str, partitioned: bool = True, version: int | None = None) -> DataFrame:
    """(source, path, bytes) of the shards: those of the log, or of a folder without one
    all Parquet files one level below."""
    table = committed(root, version)
    if table is not None:
        return spark.createDataFrame(table.select(["source", "path", "bytes"]))
    folder, name = (F.split_part("path", F.lit("/"), F.lit(i)) for i in (1, 2))
    value = F.url_decode(F.replace(F.regexp_replace(folder, "^source=", ""), F.lit("+"), F.lit("%2B")))
    source = F.when(folder.startswith("source="), value).otherwise(folder)
    return (
        list_files(spark, {"": root})
        .where(F.size(F.split("path", "/")) == 2)
        .where(name.endswith(".parquet") & ~name.startswith(".") & ~folder.startswith("_"))
        .select(source.alias("source"), "path", F.col("file_size").alias("bytes"))
    )


def vacuum(root: str, keep: int = 1) -> list[str]:
    """Delete the logs of all but the newest `keep` versions, and the shards that only
    those name; returns the paths of the shards."""
    known = versions(root) or []
    old, kept = known[:-keep], known[-keep:]
    named = {v: set(committed(root, v).column("path").to_pylist()) for v in known}
    gone = sorted(set().union(*(named[v] for v in old)) - set().union(*(named[v] for v in kept)))
    for relative in [*gone, *(f"{LOG}/{v:08d}{_SUFFIX}" for v in old)]:
        fs, path = resolve(f"{root}/{relative}")
        fs.delete_file(path)
    return gone
