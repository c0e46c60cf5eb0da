"""Expressions over paths, names, extensions and sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom import constants as C


def file_extension(path: Column) -> Column:
    """Lower-cased last suffix with its dot; '' for dot files and trailing dots."""
    return F.lower(F.regexp_extract(path, r"(?s)^(?:.*/)?[^/]+?(\.[^./]+)$", 1))


def file_type(extension: Column) -> Column:
    """The file class of a lower-case extension."""
    ladder = reduce(
        lambda acc, item: acc.when(extension.isin(item[1]), item[0]),
        C.FILE_TYPES.items(),
        F,
    )
    return ladder.otherwise(C.OTHER_TYPE)


def relative_path(full_path: Column, root: str) -> Column:
    """`full_path` below `root`."""
    return F.substring(full_path, F.lit(len(root.rstrip("/")) + 2), F.length(full_path))


def size_mb(size: Column) -> Column:
    return F.round(size / F.lit(C.MB), 2)


def size_gb(size: Column) -> Column:
    return F.round(size / F.lit(C.GB), 2)


def url_filename(url: Column) -> Column:
    """Last segment of the decoded URL path; null where the path has none."""
    path = F.coalesce(
        F.try_parse_url(url, F.lit("PATH")),
        F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1),
    )
    bare = F.regexp_replace(path, r";[^/]*$", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)
    segments = F.filter(F.split(decoded, "/"), lambda s: (s != "") & (s != "."))
    return F.try_element_at(segments, F.lit(-1))


def shard_name(source: Column, shard: Column, total: Column) -> Column:
    """`{source}-00000-of-00003.parquet`, counted from zero."""
    return F.format_string("%s-%05d-of-%05d.parquet", source, shard, total)


def path_preview(path: Column) -> Column:
    return F.substring(path, 1, C.PREVIEW_CHARS)


def matches_any(path: Column, patterns: list[str]) -> Column:
    """True where `path` contains one of the patterns (plain substrings); never null."""
    return F.coalesce(_contains_any(path, patterns), F.lit(False))


def matches_none(path: Column, patterns: list[str]) -> Column:
    """The opposite, in a form the Parquet reader accepts; a null path matches nothing."""
    return path.isNull() | ~_contains_any(path, patterns)


def _contains_any(path: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(path, F.lit(p)) for p in patterns], F.lit(False))
