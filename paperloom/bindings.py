"""The archive's tables as views over the test tables, for Spark and for SQL.

The test tables hold no files: documents stand for them, with paths, extensions and
defects derived from doc_id so that every rule has rows to act on. Sizes that the
archive counts in gigabytes are scaled down to document sizes.
"""

from __future__ import annotations

import json
import textwrap
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.content import content_md5
from paperloom.functions.paths import file_extension, file_type
from paperloom.operators.archive import content_chunks, large_files_build
from paperloom.plans.staging import scratch_path
from paperloom.schema import ARCHIVE
from paperloom.sources.export import file_export
from paperloom.sources.storage import AtomicFile

# Sizes in bytes, scaled to documents.
MAX_FILE = 20_000
CHUNK = 10_000
SHARD = 50_000
SAMPLE = 5
SAMPLE_MAX = 3_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, path, text, md5, file_size, extension, file_type); path is unique."""
    path = F.expr("""
        lang || '/' || CASE WHEN doc_id % 97 = 5 THEN '__MACOSX/' ELSE '' END
        || 'd' || CAST(doc_id AS string) || '/' ||
        CASE WHEN doc_id % 89 = 7 THEN 'dedupe_report.json' ELSE 'doc' ||
          CASE CAST(doc_id % 10 AS int) WHEN 0 THEN '.JPG' WHEN 1 THEN '.tif'
          WHEN 2 THEN '.txt' WHEN 3 THEN '.md' WHEN 4 THEN '.wav' WHEN 5 THEN '.mp4'
          WHEN 6 THEN '.pdf' WHEN 7 THEN '.XLSX' WHEN 8 THEN '.docx' ELSE '' END END""")
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id", "source", path.alias("path"), "text",
            F.md5("text").alias("md5"),
            F.octet_length("text").cast("bigint").alias("file_size"),
        )
        .withColumn("extension", file_extension(F.col("path")))
        .withColumn("file_type", file_type(F.col("extension")))
    )


FILES_SQL = r"""
files AS (
  SELECT *, CASE
      WHEN extension IN ('.jpg', '.jpeg', '.tif', '.tiff', '.png') THEN 'image'
      WHEN extension IN ('.txt', '.md', '.json') THEN 'text'
      WHEN extension IN ('.wav', '.mp3') THEN 'audio'
      WHEN extension IN ('.mp4', '.mov') THEN 'video'
      WHEN extension IN ('.pdf', '.xls', '.xlsx') THEN 'document'
      ELSE 'other' END AS file_type
  FROM (
    SELECT *, lower(regexp_extract(path, '^(?:.*/)?[^/]+?(\.[^./]+)$', 1)) AS extension
    FROM (
      SELECT doc_id, source,
        lang || '/' || CASE WHEN doc_id % 97 = 5 THEN '__MACOSX/' ELSE '' END
        || 'd' || CAST(doc_id AS VARCHAR) || '/' ||
        CASE WHEN doc_id % 89 = 7 THEN 'dedupe_report.json' ELSE 'doc' ||
          CASE CAST(doc_id % 10 AS INT) WHEN 0 THEN '.JPG' WHEN 1 THEN '.tif'
          WHEN 2 THEN '.txt' WHEN 3 THEN '.md' WHEN 4 THEN '.wav' WHEN 5 THEN '.mp4'
          WHEN 6 THEN '.pdf' WHEN 7 THEN '.XLSX' WHEN 8 THEN '.docx' ELSE '' END END AS path,
        text, md5(text) AS md5, CAST(octet_length(encode(text)) AS BIGINT) AS file_size
      FROM documents)))"""


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive rows (schema ARCHIVE), large documents cut into chunks."""
    whole = files(spark, sf_dir).select(
        "path", "source", "file_type", "file_size", "extension",
        F.encode("text", "UTF-8").alias("content"),
        F.lit(True).alias("content_available"),
    )
    return content_chunks(whole, MAX_FILE, CHUNK).select(ARCHIVE.fieldNames())


# Chunks of bytes have no SQL type that compares well; their hex text does.
ARCHIVE_SQL = (
    FILES_SQL
    + f""",
archive AS (
  SELECT path, source, file_type, file_size, extension, true AS content_available,
    CAST(i AS INT) AS chunk_index, CAST(total AS INT) AS total_chunks,
    CASE WHEN total = 1 THEN file_size
         ELSE least({CHUNK}, file_size - i * {CHUNK}) END AS nbytes,
    CASE WHEN total = 1 THEN text_hex
         ELSE substr(text_hex, i * {2 * CHUNK} + 1, {2 * CHUNK}) END AS content_hex
  FROM (
    SELECT *, unnest(range(total)) AS i FROM (
      SELECT *, hex(encode(text)) AS text_hex,
        CASE WHEN file_size > {MAX_FILE} THEN (file_size + {CHUNK - 1}) // {CHUNK}
             ELSE 1 END AS total
      FROM files)))"""
)


def large_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return large_files_build(files(spark, sf_dir), MAX_FILE)


LARGE_SQL = (
    FILES_SQL
    + f""",
large AS (
  SELECT md5(source || '/' || path) AS file_id, source, path, file_size, extension, file_type,
    'large_files/' || source || '/' || path AS repo_path,
    false AS content_available
  FROM files WHERE file_size > {MAX_FILE})"""
)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of an archive whose large files are external; external_file locates them."""
    available = F.col("file_size") <= MAX_FILE
    stored = F.concat(F.lit(C.LARGE_PREFIX), F.element_at(F.split("path", "/"), -1))
    return files(spark, sf_dir).select(
        "path", "source", "file_type", "file_size", "extension",
        available.alias("content_available"),
        F.lit(0).alias("chunk_index"),
        F.when(~available, stored).alias("external_file"),
    )


PUBLISHED_SQL = (
    FILES_SQL
    + f""",
published AS (
  SELECT path, source, file_type, file_size, extension,
    file_size <= {MAX_FILE} AS content_available, 0 AS chunk_index,
    CASE WHEN file_size > {MAX_FILE}
         THEN 'large_files/' || regexp_extract(path, '([^/]*)$', 1) END AS external_file
  FROM files)"""
)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered manifest with repeats, conflicts and missing md5s."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("f"), "doc_id").alias("id"),
        F.concat(F.lit("batch/"), F.substring(F.md5("text"), 1, 2), F.lit(".txt")).alias("path"),
        F.when(F.col("doc_id") % 17 != 0, F.md5("text")).alias("md5"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


MANIFEST_SQL = """
manifest AS (
  SELECT doc_id AS ord, 'f' || doc_id AS id,
    'batch/' || substr(md5(text), 1, 2) || '.txt' AS path,
    CASE WHEN doc_id % 17 <> 0 THEN md5(text) END AS md5,
    CAST(octet_length(encode(text)) AS BIGINT) AS size
  FROM documents)"""


def manifest_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of several folders in which the same paths occur."""
    names = table(spark, sf_dir, "documents").select("doc_id", "source").withColumnRenamed("doc_id", "ord")
    return manifest(spark, sf_dir).join(names, "ord")


SOURCES_SQL = (
    MANIFEST_SQL
    + """,
entries AS (SELECT m.*, d.source FROM manifest m JOIN documents d ON d.doc_id = m.ord)"""
)


def files_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of `files`, some entries without md5 or size."""
    return files(spark, sf_dir).select(
        F.col("doc_id").alias("ord"),
        F.concat(F.lit("f"), "doc_id").alias("id"),
        "path",
        F.when(F.col("doc_id") % 23 != 0, F.col("md5")).alias("md5"),
        F.when(F.col("doc_id") % 29 != 0, F.col("file_size")).alias("size"),
    )


def on_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files as found locally: some still partial, some damaged."""
    doc = F.col("doc_id")
    return files(spark, sf_dir).select(
        F.when(doc % 11 == 0, F.concat("path", F.lit(".part"))).otherwise(F.col("path")).alias("path"),
        (F.col("file_size") + F.when(doc % 13 == 0, 1).otherwise(0)).alias("file_size"),
        F.when(doc % 19 == 0, "bad").otherwise(F.col("md5")).alias("md5"),
    )


ON_DISK_SQL = (
    FILES_SQL
    + """,
expected AS (
  SELECT doc_id AS ord, 'f' || doc_id AS id, path,
    CASE WHEN doc_id % 23 <> 0 THEN md5 END AS md5,
    CASE WHEN doc_id % 29 <> 0 THEN file_size END AS size
  FROM files),
on_disk AS (
  SELECT CASE WHEN doc_id % 11 = 0 THEN path || '.part' ELSE path END AS path,
    file_size + CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END AS file_size,
    CASE WHEN doc_id % 19 = 0 THEN 'bad' ELSE md5 END AS md5
  FROM files)"""
)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree: regions and nations are folders, customers and orders files in them."""
    folder, plain = F.lit(C.FOLDER_MIME), F.lit("text/plain")
    none = F.lit(None).cast("string")

    def entries(name: str, key: str, own: str, parent, label: str, mime, size) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(own), key).alias("id"), parent.alias("parent_id"),
            F.col(label).alias("name"), mime.alias("mime_type"), none.alias("md5"),
            size.alias("size"), F.lit(False).alias("trashed"),
        )

    in_region = F.concat(F.lit("r"), "n_regionkey")
    in_nation = F.concat(F.lit("n"), "c_nationkey")
    return (
        entries("region", "r_regionkey", "r", none, "r_name", folder, none)
        .unionAll(entries("nation", "n_nationkey", "n", in_region, "n_name", folder, none))
        .unionAll(
            entries("customer", "c_custkey", "c", in_nation, "c_name", plain,
                    F.length("c_name").cast("string"))
        )
    )


LISTING_SQL = """
listing AS (
  SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS name,
    true AS folder, CAST(NULL AS VARCHAR) AS size FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name, true, NULL FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name, false,
    CAST(length(c_name) AS VARCHAR) FROM customer),
tree(id, path, folder, size) AS (
  SELECT id, name, folder, size FROM listing WHERE parent_id IS NULL
  UNION ALL
  SELECT l.id, t.path || '/' || l.name, l.folder, l.size
  FROM listing l JOIN tree t ON l.parent_id = t.id)"""


def scannable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`files` as whole-file archive rows, to be written out as real files."""
    return files(spark, sf_dir).select(
        "path", "source", "file_type", "file_size", "extension",
        F.encode("text", "UTF-8").alias("content"),
        F.lit(True).alias("content_available"),
        F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"),
    )


def file_tree(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    """Documents written as files in the shared folder: (folder, {source: root})."""
    out = scratch_path(spark, "tree")
    file_export(scannable(spark, sf_dir), out, scratch_path(spark, "receipts"))
    names = table(spark, sf_dir, "documents").select("source").distinct().collect()
    return out, {row.source: f"{out}/{row.source}" for row in names}


def digests(rows: DataFrame) -> DataFrame:
    """Archive rows with content replaced by its md5."""
    return rows.select(
        *[c for c in ARCHIVE.fieldNames() if c != "content"],
        content_md5(F.col("content")).alias("content_md5"),
    )


def write_json_arrays(rows: DataFrame, out: str) -> None:
    """Write a manifest as indented JSON arrays in `ord` order: one file per task, or one
    per source where there are several (the source is the file's name)."""
    if "source" in rows.columns:
        return _write_json_array_of_each_source(rows, out)

    def write(batches):
        target = None
        for batch in batches:
            for row in batch.to_pylist():
                del row["ord"]
                if target is None:
                    target = AtomicFile(f"{out}/{uuid.uuid4().hex}.json")
                    lead = "[\n"
                else:
                    lead = ",\n"
                body = textwrap.indent(json.dumps(row, indent=2), "  ")
                target.write((lead + body).encode())
            yield batch.select(["id"])
        if target is not None:
            target.write(b"\n]")
            target.publish()

    ordered = rows.repartitionByRange("ord").sortWithinPartitions("ord")
    ordered.mapInArrow(write, "id string").write.format("noop").mode("overwrite").save()


def _write_json_array_of_each_source(rows: DataFrame, out: str) -> None:
    def write(batches):
        target, current = None, None
        for batch in batches:
            for row in batch.to_pylist():
                del row["ord"]
                if (source := row.pop("source")) != current:
                    if target is not None:
                        target.write(b"\n]")
                        target.publish()
                    target, current = AtomicFile(f"{out}/{source}"), source
                    lead = "[\n"
                target.write((lead + textwrap.indent(json.dumps(row, indent=2), "  ")).encode())
                lead = ",\n"
            yield batch.select(["id"])
        if target is not None:
            target.write(b"\n]")
            target.publish()

    ordered = rows.repartition("source").sortWithinPartitions("source", "ord")
    ordered.mapInArrow(write, "id string").write.format("noop").mode("overwrite").save()
