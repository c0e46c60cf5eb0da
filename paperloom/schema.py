"""Table schemas."""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ARCHIVE = StructType([
    StructField("path", StringType()),
    StructField("source", StringType()),
    StructField("file_type", StringType()),
    StructField("file_size", LongType()),
    StructField("extension", StringType()),
    StructField("content", BinaryType()),
    StructField("content_available", BooleanType()),
    StructField("chunk_index", IntegerType()),
    StructField("total_chunks", IntegerType()),
])

# The form without chunk columns, which the validator expects by default.
ARCHIVE_UNCHUNKED = StructType(ARCHIVE.fields[:7])

LARGE_FILES = StructType([
    StructField("file_id", StringType()),
    StructField("source", StringType()),
    StructField("path", StringType()),
    StructField("file_size", LongType()),
    StructField("extension", StringType()),
    StructField("file_type", StringType()),
    StructField("repo_path", StringType()),
    StructField("content_available", BooleanType()),
])

MANIFEST_ENTRY = StructType([
    StructField("id", StringType()),
    StructField("path", StringType()),
    StructField("md5", StringType()),
    StructField("size", LongType()),
])

MANIFEST = StructType([StructField("ord", LongType()), *MANIFEST_ENTRY.fields])

LISTING = StructType([
    StructField("id", StringType()),
    StructField("parent_id", StringType()),
    StructField("name", StringType()),
    StructField("mime_type", StringType()),
    StructField("md5", StringType()),
    StructField("size", StringType()),
    StructField("trashed", BooleanType()),
])

# One row per file found under a root; `root` + "/" + `path` locates its bytes.
FILES = StructType([
    StructField("source", StringType()),
    StructField("root", StringType()),
    StructField("path", StringType()),
    StructField("file_size", LongType()),
    StructField("modified_us", LongType()),
])
