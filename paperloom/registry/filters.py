"""Filters and user predicates."""

from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import filters as O
from paperloom.registry import query


def _files(condition: str) -> str:
    return f"WITH {B.FILES_SQL} SELECT doc_id, source, path, file_size FROM files WHERE {condition}"


def _shown(df):
    return df.select("doc_id", "source", "path", "file_size")


@query(
    "exclude_patterns",
    _files(" AND ".join(f"NOT contains(path, '{p}')" for p in C.PUBLISH_EXCLUDES)),
)
def exclude_patterns(spark, sf):
    return _shown(O.exclude_patterns(B.files(spark, sf), C.PUBLISH_EXCLUDES))


@query("filter_extension", _files("extension = '.pdf'"))
def filter_extension(spark, sf):
    return _shown(O.filter_extension(B.files(spark, sf), ".pdf"))


@query("filter_file_type", _files("file_type = 'image'"))
def filter_file_type(spark, sf):
    return _shown(O.filter_file_type(B.files(spark, sf), "image"))


@query("filter_size", _files("file_size > 10000"))
def filter_size(spark, sf):
    return _shown(O.filter_size(B.files(spark, sf), 10_000))


@query("path_search", _files("contains(path, 'd10')"))
def path_search(spark, sf):
    return _shown(O.path_search(B.files(spark, sf), "d10"))


@query("filter_source", _files("source = 'src3'"))
def filter_source(spark, sf):
    return _shown(O.filter_source(B.files(spark, sf), "src3"))


@query(
    "row_predicate",
    _files("contains(path, '.pdf') AND file_size > 1500"),
)
def row_predicate(spark, sf):
    def wanted(rows):
        return rows["path"].str.contains(".pdf", regex=False) & (rows["file_size"] > 1500)

    return _shown(O.row_predicate(B.files(spark, sf), wanted, ["path", "file_size"]))


def _published(condition: str) -> str:
    return f"WITH {B.PUBLISHED_SQL} SELECT source, path, external_file FROM published WHERE {condition}"


@query("filter_external", _published("external_file IS NOT NULL"))
def filter_external(spark, sf):
    return O.filter_external(B.published(spark, sf)).select("source", "path", "external_file")


@query("filter_available", _published("content_available"))
def filter_available(spark, sf):
    return O.filter_available(B.published(spark, sf)).select("source", "path", "external_file")


# Side tables with some entries in the wrong place.
MISPLACED_SQL = (
    B.FILES_SQL
    + """,
side AS (
  SELECT source, path, extension = '.wav' AS content_available, CASE extension
    WHEN '.txt' THEN 'files/' || path WHEN '.md' THEN NULL ELSE 'large_files/' || path
    END AS repo_path
  FROM files WHERE file_size > 3000)"""
)


def misplaced(spark, sf):
    extension = F.col("extension")
    repo_path = (
        F.when(extension == ".txt", F.concat(F.lit("files/"), "path"))
        .when(extension != ".md", F.concat(F.lit(C.LARGE_PREFIX), "path"))
    )
    return B.files(spark, sf).where("file_size > 3000").select(
        "source", "path", (extension == ".wav").alias("content_available"),
        repo_path.alias("repo_path"),
    )


@query(
    "filter_repo_path",
    f"""WITH {MISPLACED_SQL} SELECT source, path, repo_path FROM side
    WHERE repo_path IS NULL OR NOT starts_with(repo_path, 'large_files/')""",
)
def filter_repo_path(spark, sf):
    return O.misplaced_repo_paths(misplaced(spark, sf)).select("source", "path", "repo_path")
