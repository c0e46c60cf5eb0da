"""Scalar functions and row-wise projections."""

from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.functions import content, paths
from paperloom.operators.manifest import manifest_project
from paperloom.plans.tree import tree_paths
from paperloom.registry import query


@query("file_extension", f"WITH {B.FILES_SQL} SELECT doc_id, extension FROM files")
def file_extension(spark, sf):
    return B.files(spark, sf).select("doc_id", "extension")


@query("file_type", f"WITH {B.FILES_SQL} SELECT doc_id, extension, file_type FROM files")
def file_type(spark, sf):
    return B.files(spark, sf).select("doc_id", "extension", "file_type")


@query(
    "relative_path",
    f"WITH {B.FILES_SQL} SELECT doc_id, source || '/' || path AS relative_path FROM files",
)
def relative_path(spark, sf):
    full = F.concat_ws("/", F.lit("/data/archives"), "source", "path")
    relative = paths.relative_path(full, "/data/archives")
    return B.files(spark, sf).select("doc_id", relative.alias("relative_path"))


@query(
    "size_units",
    f"""WITH {B.FILES_SQL}
    SELECT doc_id, round(file_size / {C.MB}, 2) AS size_mb,
      round(file_size * 100000 / {C.GB}, 2) AS scaled_gb FROM files""",
)
def size_units(spark, sf):
    size = F.col("file_size")
    return B.files(spark, sf).select(
        "doc_id",
        paths.size_mb(size).alias("size_mb"),
        paths.size_gb(size * 100000).alias("scaled_gb"),
    )


@query(
    "url_filename",
    r"""SELECT page_id, nullif(regexp_extract(rtrim(url_decode(
      regexp_extract(url, '^[^:]+://[^/?#]*([^?#;]*)', 1)), '/'), '([^/]*)$', 1), '') AS filename
    FROM pages""",
)
def url_filename(spark, sf):
    pages = B.table(spark, sf, "pages")
    return pages.select("page_id", paths.url_filename(F.col("url")).alias("filename"))


@query(
    "manifest_project",
    f"""WITH RECURSIVE {B.LISTING_SQL}
    SELECT id, path, CAST(NULL AS VARCHAR) AS md5, try_cast(size AS BIGINT) AS size
    FROM tree WHERE NOT folder""",
)
def manifest_projection(spark, sf):
    return manifest_project(tree_paths(B.listing(spark, sf)))


@query("content_md5", f"WITH {B.FILES_SQL} SELECT doc_id, md5 AS content_md5 FROM files")
def content_md5(spark, sf):
    digest = content.content_md5(F.encode("text", "UTF-8"))
    return B.files(spark, sf).select("doc_id", digest.alias("content_md5"))


ARCHIVE_DIGESTS = """SELECT path, source, file_type, file_size, extension, content_available,
    chunk_index, total_chunks, md5(unhex(content_hex)) AS content_md5 FROM archive"""


@query("content_chunks", f"WITH {B.ARCHIVE_SQL} {ARCHIVE_DIGESTS}")
def content_chunks(spark, sf):
    return B.digests(B.archive(spark, sf))


@query(
    "shard_name",
    f"""WITH {B.FILES_SQL}
    SELECT doc_id, printf('%s-%05d-of-%05d.parquet', source, doc_id % 75, 75) AS shard_file
    FROM files""",
)
def shard_name(spark, sf):
    shard = (F.col("doc_id") % 75).cast("int")
    name = paths.shard_name(F.col("source"), shard, F.lit(75))
    return B.files(spark, sf).select("doc_id", name.alias("shard_file"))


@query(
    "content_location",
    f"""WITH {B.FILES_SQL}
    SELECT doc_id, CASE WHEN file_size <= 4000 THEN 'embedded'
      WHEN extension <> '.mp4' THEN 'external' ELSE 'unavailable' END AS location FROM files""",
)
def content_location(spark, sf):
    external = F.when(F.col("extension") != ".mp4", F.concat(F.lit("large_files/"), "path"))
    location = content.content_location(F.col("file_size") <= 4000, external)
    return B.files(spark, sf).select("doc_id", location.alias("location"))


@query("path_preview", f"WITH {B.FILES_SQL} SELECT doc_id, substr(path, 1, 50) AS preview FROM files")
def path_preview(spark, sf):
    return B.files(spark, sf).select("doc_id", paths.path_preview(F.col("path")).alias("preview"))
