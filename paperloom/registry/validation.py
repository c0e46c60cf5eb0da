"""Validation checks."""

from functools import cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import validation as O
from paperloom.plans.staging import scratch_path
from paperloom.registry import query
from paperloom.registry.filters import MISPLACED_SQL, misplaced
from paperloom.registry.sampling import SAMPLE_STATS_SQL
from paperloom.registry.summaries import SHARDS_SQL
from paperloom.schema import ARCHIVE, LARGE_FILES
from paperloom.sources import footers
from paperloom.sources.commits import shards
from paperloom.sources.shards import archive_write
from paperloom.sources.storage import AtomicFile, resolve


@query(
    "large_file_rules",
    f"""WITH {MISPLACED_SQL} SELECT source, CAST(count(*) AS BIGINT) AS files,
      CAST(count(*) FILTER (NOT coalesce(starts_with(repo_path, 'large_files/'), false)) AS BIGINT)
        AS invalid_repo_path,
      CAST(count(*) FILTER (content_available) AS BIGINT) AS content_available
    FROM side GROUP BY source""",
)
def large_file_rules(spark, sf):
    return O.large_file_rules(misplaced(spark, sf))


@query(
    "unwanted_files",
    f"""WITH {B.FILES_SQL} SELECT source, CAST(count(*) AS BIGINT) AS unwanted, min(path) AS example
    FROM files WHERE contains(path, 'dedupe_report.json') GROUP BY source""",
)
def unwanted_files(spark, sf):
    return O.unwanted_files(B.files(spark, sf))


# Two documents in three start with the bytes their extension calls for.
SIGNED_SQL = (
    B.FILES_SQL
    + f""",
signed AS (
  SELECT doc_id, path, source, file_type, file_size, extension,
    file_size <= {B.MAX_FILE} AS content_available, 0 AS chunk_index,
    CASE WHEN doc_id % 3 <> 0 THEN CASE extension WHEN '.pdf' THEN '25504446'
      WHEN '.jpg' THEN 'FFD8FF' WHEN '.tif' THEN '49492A00' ELSE '' END ELSE '' END
      || hex(encode(text)) AS content_hex
  FROM files),
probed AS (
  SELECT source, extension, CAST(count(*) AS BIGINT) AS tested,
    CAST(count(*) FILTER (NOT CASE extension
      WHEN '.pdf' THEN starts_with(content_hex, '25504446')
      WHEN '.jpg' THEN starts_with(content_hex, 'FFD8FF')
      ELSE starts_with(content_hex, '49492A00') OR starts_with(content_hex, '4D4D002A')
      END) AS BIGINT) AS unusable
  FROM signed WHERE extension IN ('.pdf', '.jpg', '.tif') AND content_available
  GROUP BY source, extension)"""
)


def signed(spark, sf):
    extension = F.col("extension")
    mark = (
        F.when(F.col("doc_id") % 3 == 0, F.lit(""))
        .when(extension == ".pdf", "25504446")
        .when(extension == ".jpg", "FFD8FF")
        .when(extension == ".tif", "49492A00")
        .otherwise("")
    )
    return B.files(spark, sf).select(
        "path", "source", "file_type", "file_size", "extension",
        F.concat(F.unhex(mark), F.encode("text", "UTF-8")).alias("content"),
        (F.col("file_size") <= B.MAX_FILE).alias("content_available"),
        F.lit(0).alias("chunk_index"),
    )


@query("content_probe", f"WITH {SIGNED_SQL} SELECT * FROM probed")
def content_probe(spark, sf):
    return O.content_probe(signed(spark, sf))


@query(
    "chunk_completeness",
    f"""WITH {B.ARCHIVE_SQL},
    kept AS (SELECT * FROM archive WHERE NOT (chunk_index = 1 AND total_chunks > 1 AND extension = '.pdf'))
    SELECT source, path, CAST(count(*) AS BIGINT) AS chunks,
      CAST(max(total_chunks) AS BIGINT) AS total_chunks, max(file_size) AS file_size,
      CAST(sum(length(content_hex) // 2) AS BIGINT) AS bytes,
      count(*) = max(total_chunks) AND count(DISTINCT chunk_index) = max(total_chunks)
        AND min(chunk_index) = 0 AND max(chunk_index) = max(total_chunks) - 1
        AND sum(length(content_hex) // 2) = max(file_size) AS complete
    FROM kept GROUP BY source, path""",
)
def chunk_completeness(spark, sf):
    lost = (F.col("chunk_index") == 1) & (F.col("total_chunks") > 1) & (F.col("extension") == ".pdf")
    return O.chunk_completeness(B.archive(spark, sf).where(~lost))


def _damage(batches):
    """Write shards anew: the first one of src1 without chunk columns, that of src2 with
    sizes of another type, that of src3 with one more column."""
    for batch in batches:
        for source, uri in zip(batch.column("source").to_pylist(), batch.column("uri").to_pylist()):
            fs, path = resolve(uri)
            with fs.open_input_file(path) as handle:
                rows = pq.read_table(handle)
            at = rows.schema.get_field_index("file_size")
            if source == "src1":
                rows = rows.drop_columns(["chunk_index", "total_chunks"])
            elif source == "src2":
                rows = rows.set_column(at, "file_size", rows.column(at).cast(pa.int32()))
            else:
                rows = rows.append_column("note", pa.nulls(len(rows), pa.string()))
            file = AtomicFile(uri)
            pq.write_table(rows, file.stream)
            file.publish()
        yield batch


@cache
def _damaged(spark, sf):
    out = scratch_path(spark, "archive")
    archive_write(B.archive(spark, sf), out, B.SHARD)
    first = F.contains("path", F.lit("-00000-of-")) & F.col("source").isin("src1", "src2", "src3")
    hit = shards(spark, out).where(first).select("source", F.concat(F.lit(f"{out}/"), "path").alias("uri"))
    hit.mapInArrow(_damage, "source string, uri string").write.format("noop").mode("overwrite").save()
    return out


ON_DISK_SCHEMAS_SQL = (
    SHARDS_SQL
    + """,
wanted(name, type) AS (VALUES ('path', 'string'), ('source', 'string'), ('file_type', 'string'), ('file_size', 'bigint'),
  ('extension', 'string'), ('content', 'binary'), ('content_available', 'boolean'), ('chunk_index', 'int'), ('total_chunks', 'int')),
on_disk AS (
  SELECT source AS subset, name AS "column", type, shards - CAST(source = 'src1' AND name IN ('chunk_index', 'total_chunks')
    OR source = 'src2' AND name = 'file_size' AS BIGINT) AS files FROM shards, wanted
  UNION ALL SELECT source, 'file_size', 'int', 1 FROM shards WHERE source = 'src2'
  UNION ALL SELECT source, 'note', 'string', 1 FROM shards WHERE source = 'src3')"""
)


@query("schemas_on_disk", f"WITH RECURSIVE {ON_DISK_SCHEMAS_SQL} SELECT * FROM on_disk WHERE files > 0")
def schemas_on_disk(spark, sf):
    return footers.schemas_on_disk(footers.shard_footers(spark, _damaged(spark, sf)))


@query(
    "schema_diff_on_disk",
    f"""WITH RECURSIVE {SHARDS_SQL} SELECT source AS subset, c AS "column", kind, CAST(1 AS BIGINT) AS files, severity
    FROM shards JOIN (VALUES ('src1', 'chunk_index', 'missing', 'error'), ('src1', 'total_chunks', 'missing', 'error'),
      ('src2', 'file_size', 'type', 'warning'), ('src3', 'note', 'extra', 'warning')) planted(s, c, kind, severity) ON s = source""",
)
def schema_diff_on_disk(spark, sf):
    return O.schema_diff_on_disk(footers.shard_footers(spark, _damaged(spark, sf)), ARCHIVE)


@query(
    "validate_archive_on_disk",
    f"""WITH RECURSIVE {SHARDS_SQL} SELECT source AS subset, detail, CAST(1 AS BIGINT) AS n, severity
    FROM shards JOIN (VALUES ('src1', 'missing chunk_index', 'error'), ('src1', 'missing total_chunks', 'error'),
      ('src2', 'type file_size', 'warning'), ('src3', 'extra note', 'warning')) planted(s, detail, severity) ON s = source""",
)
def validate_archive_on_disk(spark, sf):
    """What the validation of an archive with planted damage says of its schemas."""
    out = _damaged(spark, sf)
    rows = B.archive(spark, sf)
    checks = O.validate_archive(
        rows, spark.createDataFrame([], LARGE_FILES), rows.select("source"), expected_schema=ARCHIVE, probe_content=False,
        footers=footers.shard_footers(spark, out))
    return checks.where(F.col("check") == "schema").select("subset", "detail", "n", "severity")


def _chunk(kind: str, data):
    typed = F.concat(F.encode(F.lit(kind), "UTF-8"), data)
    return F.concat(_word(F.octet_length(data)), typed, _word(F.crc32(typed)))


def _word(number):
    return F.unhex(F.lpad(F.hex(number), 8, "0"))


def containers(spark, sf):
    """Documents as whole files of four formats; some are cut short, some have a wrong byte."""
    doc = F.col("doc_id")
    kind = (doc % 4).cast("int")
    plain = F.encode("text", "UTF-8")
    size = F.octet_length(plain)
    data = F.when((kind == 0) & (doc % 17 == 1) & (size > 0), F.concat(F.unhex(F.lit("00")), F.substr(plain, F.lit(2)))).otherwise(plain)
    header = F.unhex(F.lit("00000001000000010800000000"))
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A")), _chunk("IHDR", header), _word(size), F.encode(F.lit("IDAT"), "UTF-8"), data,
                   _word(F.crc32(F.concat(F.encode(F.lit("IDAT"), "UTF-8"), plain))), _chunk("IEND", F.unhex(F.lit(""))))
    jpeg = F.concat(F.unhex(F.lit("FFD8FFE000044A46FFC000040000FFDA00040000")), data, F.unhex(F.lit("FFD9")))
    little = lambda n: F.concat(*[F.substr(_word(n), F.lit(i), F.lit(1)) for i in (4, 3, 2, 1)])
    tiff = F.concat(F.unhex(F.lit("49492A00")), little(size + 8), data, F.unhex(F.lit("02001101040001000000")), F.unhex(F.lit("08000000")),
                    F.unhex(F.lit("1701040001000000")), little(size), F.unhex(F.lit("00000000")))
    pdf = F.concat(F.encode(F.lit("%PDF-1.4\n"), "UTF-8"), data, F.encode(F.concat(
        F.lit("\nxref\n0 1\ntrailer <<>>\nstartxref\n"), (size + 10).cast("string"), F.lit("\n%%EOF\n")), "UTF-8"))
    content = F.when(kind == 0, png).when(kind == 1, jpeg).when(kind == 2, tiff).otherwise(pdf)
    cut = F.when(doc % 13 == 0, F.substr(content, F.lit(1), F.octet_length(content) - 8)).otherwise(content)
    return B.files(spark, sf).select(
        "source", "path", F.element_at(F.array(*map(F.lit, (".png", ".jpg", ".tif", ".pdf"))), kind + 1).alias("extension"),
        cut.alias("content"), F.lit(True).alias("content_available"), F.lit(1).alias("total_chunks"))


@query(
    "structure_probe",
    f"""WITH {B.FILES_SQL}, made AS (SELECT source, path, CASE doc_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.tif' ELSE '.pdf' END AS extension,
      doc_id % 13 = 0 OR doc_id % 4 = 0 AND doc_id % 17 = 1 AND text <> '' AS bad FROM files)
    SELECT source, extension, CAST(count(*) AS BIGINT) AS tested, CAST(count(*) FILTER (bad) AS BIGINT) AS damaged, min(path) FILTER (bad) AS example
    FROM made GROUP BY source, extension""",
)
def structure_probe(spark, sf):
    return O.structure_probe(containers(spark, sf))


CHECKS_SQL = (
    SIGNED_SQL
    + f""",
running AS (
  SELECT *, count(*) FILTER (file_size <= {B.SAMPLE_MAX}) OVER (PARTITION BY source
      ORDER BY path, chunk_index ROWS UNBOUNDED PRECEDING) AS hits FROM signed),
sample AS (SELECT * FROM running WHERE file_size <= {B.SAMPLE_MAX} AND hits <= {B.SAMPLE}),
stats AS ({SAMPLE_STATS_SQL}),
side AS (
  SELECT extension = '.wav' AS content_available, CASE extension
    WHEN '.txt' THEN 'files/' || path WHEN '.md' THEN NULL ELSE 'large_files/' || path
    END AS repo_path
  FROM files WHERE file_size > 3000),
checks AS (
  SELECT n_name AS subset, 'missing_subset' AS "check", 'warning' AS severity,
    CAST(NULL AS VARCHAR) AS detail, 1 AS n
  FROM nation WHERE n_name NOT IN (SELECT source FROM signed)
  UNION ALL SELECT source, 'schema', 'warning', 'extra chunk_index', 1
  FROM (SELECT DISTINCT source FROM signed)
  UNION ALL SELECT 'large_files', 'schema', 'error', 'missing ' || c, 1
  FROM (VALUES ('file_id'), ('file_size'), ('extension'), ('file_type')) v(c)
  WHERE (SELECT count(*) FROM side) > 0
  UNION ALL SELECT source, 'no_data', 'error', NULL, checked FROM stats WHERE sampled = 0
  UNION ALL SELECT * FROM (SELECT 'large_files', 'repo_path', 'error', NULL, count(*) AS n FROM side
    WHERE NOT coalesce(starts_with(repo_path, 'large_files/'), false)) WHERE n > 0
  UNION ALL SELECT * FROM (SELECT 'large_files', 'large_content', 'warning', NULL, count(*) AS n
    FROM side WHERE content_available) WHERE n > 0
  UNION ALL SELECT source, 'unwanted_files', 'error', min(path), count(*) FROM sample
    WHERE contains(path, 'dedupe_report.json') GROUP BY source
  UNION ALL SELECT source, 'sampled', 'info', skipped || '/' || checked, sampled FROM stats
  UNION ALL SELECT source, 'content_available', 'info',
    CAST(round(count(*) FILTER (content_available) * 100.0 / count(*), 1) AS VARCHAR),
    count(*) FILTER (content_available) FROM sample GROUP BY source
  UNION ALL SELECT source, 'file_type', 'info', file_type, n FROM (
    SELECT source, file_type, count(*) AS n, row_number() OVER (PARTITION BY source
      ORDER BY count(*) DESC, file_type) AS rn FROM sample GROUP BY source, file_type) WHERE rn <= 5
  UNION ALL SELECT source, 'extension', 'info', extension, n FROM (
    SELECT source, extension, count(*) AS n, row_number() OVER (PARTITION BY source
      ORDER BY count(*) DESC, extension) AS rn FROM sample GROUP BY source, extension) WHERE rn <= 5
  UNION ALL SELECT source, 'content', 'warning', extension, unusable FROM probed WHERE unusable > 0)"""
)


@query(
    "validate_archive",
    f'WITH {CHECKS_SQL} SELECT subset, "check", severity, detail, CAST(n AS BIGINT) AS n FROM checks',
)
def validate_archive(spark, sf):
    nations = B.table(spark, sf, "nation").select(F.col("n_name").alias("source"))
    rows = signed(spark, sf)
    return O.validate_archive(
        rows,
        misplaced(spark, sf),
        expected_subsets=nations.unionAll(rows.select("source")),
        exclude=C.REPORT_EXCLUDES,
        sample_rows=B.SAMPLE,
        max_bytes=B.SAMPLE_MAX,
    )


@query(
    "validation_verdict",
    f"""WITH {CHECKS_SQL} SELECT count(*) FILTER (severity = 'error') = 0 AS success,
      CAST(count(*) FILTER (severity = 'error') AS BIGINT) AS errors,
      CAST(count(*) FILTER (severity = 'warning') AS BIGINT) AS warnings FROM checks""",
)
def validation_verdict(spark, sf):
    return O.validation_verdict(validate_archive(spark, sf))
