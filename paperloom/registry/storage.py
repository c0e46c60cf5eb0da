"""Sources and sinks. Files are first written from the tables to the shared folder."""

from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import archive as O
from paperloom.operators import rewrite
from paperloom.operators.manifest import conflict_sample, dedupe_stats, verify_manifest
from paperloom.plans.ordering import row_positions
from paperloom.plans.staging import scratch_path
from paperloom.registry import query
from paperloom.registry.manifests import CONFLICT_SAMPLE_SQL, FIRSTS_SQL, STATS_SQL
from paperloom.registry.projections import ARCHIVE_DIGESTS
from paperloom.registry.summaries import SHARDS_SQL
from paperloom.sources import archive, manifest
from paperloom.sources.content import files_on_disk, load_content
from paperloom.sources.digests import file_digests
from paperloom.sources.export import file_export, large_files_publish
from paperloom.sources.listing import list_files
from paperloom.sources.shards import archive_write

_NOT_EXCLUDED = " AND ".join(f"NOT contains(path, '{p}')" for p in C.CONVERT_EXCLUDES)


@cache
def _file_tree(spark, sf):
    return B.file_tree(spark, sf)[1]


@cache
def _written(spark, sf):
    """The archive as shards on disk, shared by the queries that only read it."""
    out = scratch_path(spark, "archive")
    archive_write(B.archive(spark, sf), out, B.SHARD)
    return out


@query("archive_scan", f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS} WHERE {_NOT_EXCLUDED}")
def archive_scan(spark, sf):
    scanned = archive.archive_scan(
        spark, _file_tree(spark, sf), max_bytes=B.MAX_FILE, chunk_bytes=B.CHUNK
    )
    return B.digests(scanned)


@query(
    "archive_scan_external",
    f"""WITH {B.FILES_SQL} SELECT path, source, file_type, file_size, extension,
      file_size <= {B.MAX_FILE} AS content_available, 0 AS chunk_index, 1 AS total_chunks,
      CASE WHEN file_size <= {B.MAX_FILE} THEN md5 END AS content_md5
    FROM files WHERE {_NOT_EXCLUDED}""",
)
def archive_scan_external(spark, sf):
    scanned = archive.archive_scan(
        spark, _file_tree(spark, sf), large="external", max_bytes=B.MAX_FILE
    )
    return B.digests(scanned)


@query("archive_write", f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS} WHERE {_NOT_EXCLUDED}")
def write_from_files(spark, sf):
    listed = list_files(spark, _file_tree(spark, sf))
    rows = archive.plan_rows(listed, max_bytes=B.MAX_FILE, chunk_bytes=B.CHUNK)
    out = scratch_path(spark, "archive")
    archive_write(rows, out, B.SHARD)
    return B.digests(archive.read_archive(spark, out))


@query("archive_write_table", f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS}")
def write_from_table(spark, sf):
    out = scratch_path(spark, "archive")
    archive_write(B.archive(spark, sf), out, B.SHARD)
    return B.digests(archive.read_archive(spark, out))


@query("subset_scan", f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS} WHERE source = 'src3'")
def subset_scan(spark, sf):
    return B.digests(archive.subset_scan(spark, _written(spark, sf), "src3"))


@query(
    "all_subsets_scan",
    f"""WITH {B.ARCHIVE_SQL} SELECT source, CAST(count(*) AS BIGINT) AS files, 9 AS columns
    FROM archive GROUP BY source""",
)
def all_subsets_scan(spark, sf):
    subsets = archive.all_subsets_scan(spark, _written(spark, sf))
    width = F.lit(len(next(iter(subsets.values())).columns))
    return O.count_by_source(O.concat_subsets(list(subsets.values()))).withColumn("columns", width)


@query("discover_subsets", f"WITH RECURSIVE {SHARDS_SQL} SELECT source, shards FROM shards")
def discover_subsets(spark, sf):
    return archive.discover_subsets(spark, _written(spark, sf)).select("source", "shards")


@query(
    "edge_files",
    f"""WITH RECURSIVE {SHARDS_SQL} SELECT source, min(shard_file) AS file FROM planned GROUP BY source
    UNION SELECT source, max(shard_file) FROM planned GROUP BY source""",
)
def edge_files(spark, sf):
    shards = list_files(spark, {"": _written(spark, sf)}).where(F.col("path").endswith(".parquet"))
    folder, file = (F.split_part("path", F.lit("/"), F.lit(i)) for i in (1, 2))
    return O.edge_files(shards.select(F.replace(folder, F.lit("source=")).alias("source"), file.alias("file")))


_PER_FILE = f"""WITH RECURSIVE {SHARDS_SQL},
counts AS (
  SELECT source, shard_file AS file, CAST(count(*) AS BIGINT) AS rows_before,
    CAST(count(*) FILTER (NOT contains(path, 'dedupe_report.json')) AS BIGINT) AS rows_kept,
    CAST(count(*) FILTER (contains(path, 'dedupe_report.json')) AS BIGINT) AS rows_removed
  FROM planned GROUP BY source, shard_file)"""


@query("removed_rows", f"{_PER_FILE} SELECT * FROM counts")
def removed_rows(spark, sf):
    counts = rewrite.removed_rows(spark, _written(spark, sf))
    return counts.drop("file_bytes").withColumn("file", F.element_at(F.split("file", "/"), -1))


@query(
    "removed_rows_edges",
    f"""{_PER_FILE} SELECT c.* FROM counts c JOIN (
      SELECT source, min(file) AS a, max(file) AS b FROM counts GROUP BY source) e
    ON c.source = e.source AND (c.file = e.a OR c.file = e.b)""",
)
def removed_rows_edges(spark, sf):
    counts = rewrite.removed_rows(spark, _written(spark, sf), edges_only=True)
    return counts.drop("file_bytes").withColumn("file", F.element_at(F.split("file", "/"), -1))


@query(
    "removal_totals",
    f"""{_PER_FILE} SELECT CAST(count(*) FILTER (rows_removed > 0) AS BIGINT) AS files_modified,
      CAST(sum(rows_removed) AS BIGINT) AS total_removed FROM counts""",
)
def removal_totals(spark, sf):
    return rewrite.removal_totals(rewrite.removed_rows(spark, _written(spark, sf)))


@query(
    "filter_archive",
    f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS} WHERE NOT contains(path, 'dedupe_report.json')",
)
def filter_archive(spark, sf):
    out = scratch_path(spark, "archive")
    archive_write(B.archive(spark, sf), out, B.SHARD)
    rewrite.filter_archive(spark, out)
    return B.digests(archive.read_archive(spark, out))


@query(
    "archive_replace",
    f"""WITH {B.FILES_SQL} SELECT v AS version, source, CAST(count(*) AS BIGINT) AS files, CAST(sum(file_size) AS BIGINT) AS bytes
    FROM files, (VALUES (1), (2)) versions(v) WHERE v = 1 OR doc_id % 2 = 0 GROUP BY v, source""",
)
def archive_replace(spark, sf):
    """An archive that a second write replaced, read as it is and as it was."""
    out = scratch_path(spark, "archive")
    rows = B.scannable(spark, sf)
    archive_write(rows, out, B.SHARD)
    even = B.files(spark, sf).where("doc_id % 2 = 0").select("source", "path")
    archive_write(rows.join(even, ["source", "path"], "left_semi"), out, B.SHARD, replace=True)
    return reduce(DataFrame.unionAll, [
        archive.read_archive(spark, out, version=v).groupBy(F.lit(v).alias("version"), "source").agg(
            F.count("*").alias("files"), F.sum("file_size").alias("bytes")) for v in (1, 2)])


@query("chunked_md5", f"WITH {B.FILES_SQL} SELECT source, path, file_size, md5 FROM files")
def chunked_md5(spark, sf):
    """Digests of whole files, from the chunks of an archive on disk."""
    return file_digests(archive.read_archive(spark, _written(spark, sf)))


@query(
    "verify_archive",
    f"""WITH {B.FILES_SQL} SELECT source, path, CASE WHEN doc_id % 31 = 0 THEN 'md5_mismatch'
      WHEN doc_id % 37 = 0 THEN 'size_mismatch' WHEN doc_id % 41 = 0 THEN 'missing' ELSE 'ok' END AS status FROM files""",
)
def verify_archive(spark, sf):
    """A manifest with wrong digests, sizes and paths against an archive on disk."""
    doc = F.col("doc_id")
    wanted = B.files(spark, sf).select(
        doc.alias("ord"), "source",
        F.when((doc % 41 == 0) & (doc % 31 != 0) & (doc % 37 != 0), F.concat("path", F.lit("?"))).otherwise(F.col("path")).alias("path"),
        F.when(doc % 31 == 0, "bad").otherwise(F.col("md5")).alias("md5"),
        (F.col("file_size") + F.when((doc % 37 == 0) & (doc % 31 != 0), 1).otherwise(0)).alias("size"),
    )
    found = verify_manifest(wanted, file_digests(archive.read_archive(spark, _written(spark, sf))))
    return found.select("source", F.rtrim("path", F.lit("?")).alias("path"), "status")


@query(
    "large_files_build",
    f"WITH {B.LARGE_SQL} SELECT * FROM large",
)
def large_files_build(spark, sf):
    return B.large_files(spark, sf)


@query("file_export", f"WITH {B.FILES_SQL} SELECT source, path, file_size AS written FROM files")
def export(spark, sf):
    out, receipts = scratch_path(spark, "export"), scratch_path(spark, "receipts")
    return file_export(B.archive(spark, sf), out, receipts).select("source", "path", "written")


@query(
    "file_verify",
    f"WITH {B.FILES_SQL} SELECT source, path, file_size, md5 FROM files",
)
def file_verify(spark, sf):
    """Chunked rows exported, listed and digested: the bytes must come back whole."""
    out = scratch_path(spark, "export")
    file_export(B.archive(spark, sf), out, scratch_path(spark, "receipts"))
    return files_on_disk(spark, {"": out}).select(
        F.split_part("path", F.lit("/"), F.lit(1)).alias("source"),
        F.regexp_replace("path", "^[^/]*/", "").alias("path"),
        "file_size", "md5",
    )


@query(
    "content_load",
    f"""WITH {B.FILES_SQL}, sizes AS (SELECT *, CASE WHEN file_size > {B.MAX_FILE}
      THEN (file_size + {B.CHUNK - 1}) // {B.CHUNK} ELSE 1 END AS chunks FROM files)
    SELECT source, path, location, chunk_index, CASE WHEN location = 'embedded' THEN md5
      ELSE md5(unhex(substr(hex(encode(text)), chunk_index * {2 * B.CHUNK} + 1, {2 * B.CHUNK})))
      END AS content_md5
    FROM (SELECT *, CASE WHEN chunks = 1 THEN 'embedded' ELSE 'external' END AS location,
      CAST(unnest(range(chunks)) AS INT) AS chunk_index FROM sizes) WHERE {_NOT_EXCLUDED}""",
)
def content_load(spark, sf):
    """Large files published outside the archive and read back next to embedded ones."""
    tree = _file_tree(spark, sf)
    repo = scratch_path(spark, "repo")
    listed = list_files(spark, tree)
    rows = archive.plan_rows(listed, large="external", max_bytes=B.MAX_FILE)
    archive_write(rows, repo, B.SHARD)
    side = O.large_files_build(rows, B.MAX_FILE)
    archive.large_files_write(side, repo)
    large_files_publish(listed, side, repo, scratch_path(spark, "receipts"))
    loaded = load_content(
        archive.read_archive(spark, repo), archive.large_files_scan(spark, repo), repo, B.CHUNK
    )
    return loaded.select(
        "source", "path", "location", "chunk_index", F.md5("content").alias("content_md5")
    )


@query("manifest_scan", f"""WITH {B.MANIFEST_SQL} SELECT row_number() OVER (ORDER BY ord) AS position, id, path, md5, size FROM manifest""")
def manifest_scan(spark, sf):
    """Manifests of one source in the order of their entries: the n-th by `ord` is the n-th."""
    out = scratch_path(spark, "manifest")
    B.write_json_arrays(B.manifest(spark, sf).withColumn("source", F.lit("one")), out)
    return _positions(manifest.manifest_scan(spark, f"{out}/one").withColumn("source", F.lit("one"))).drop("source")


@query(
    "manifest_scan_by_source",
    f"""WITH {B.SOURCES_SQL} SELECT source, row_number() OVER (ORDER BY source, ord) AS position,
    id, path, md5, size FROM entries""",
)
def manifest_scan_by_source(spark, sf):
    """A folder of manifests: `ord` orders all of them."""
    out = scratch_path(spark, "manifest")
    B.write_json_arrays(B.manifest_of_sources(spark, sf), out)
    return _positions(manifest.manifest_scan(spark, out))


def _positions(entries):
    placed = row_positions(entries.withColumn("all", F.lit(0)), ["all"], ["ord"], "position")
    return placed.withColumn("position", F.col("position") + 1).drop("all", "ord")


@query("manifest_write", f"WITH {B.MANIFEST_SQL} SELECT ord, id, path, md5, size FROM manifest")
def manifest_write(spark, sf):
    out = scratch_path(spark, "manifest")
    manifest.manifest_write(B.manifest(spark, sf), out)
    return manifest.manifest_lines(spark, out)


@query("report_write", f"WITH {FIRSTS_SQL} {STATS_SQL}")
def report_write(spark, sf):
    out = scratch_path(spark, "report")
    rows = B.manifest(spark, sf)
    stats = dedupe_stats(rows)
    manifest.report_write(stats, conflict_sample(rows), out)
    return spark.read.schema(stats.schema).json(f"{out}/stats")


@query("report_conflicts", CONFLICT_SAMPLE_SQL)
def report_conflicts(spark, sf):
    """The conflict half of a report, read back."""
    out = scratch_path(spark, "report")
    rows = B.manifest(spark, sf)
    conflicts = conflict_sample(rows)
    manifest.report_write(dedupe_stats(rows), conflicts, out)
    return spark.read.schema(conflicts.schema).json(f"{out}/conflicts_sample")
