"""Row filters. Each is one predicate, so it is pushed to the scan where possible."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.functions.paths import matches_none


def exclude_patterns(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Drop rows whose path contains any of the patterns."""
    return df.where(matches_none(F.col("path"), patterns))


def filter_extension(df: DataFrame, extension: str) -> DataFrame:
    return df.where(F.col("extension") == extension)


def filter_file_type(df: DataFrame, file_type: str) -> DataFrame:
    return df.where(F.col("file_type") == file_type)


def filter_size(df: DataFrame, above: int) -> DataFrame:
    return df.where(F.col("file_size") > above)


def filter_external(df: DataFrame) -> DataFrame:
    return df.where(F.col("external_file").isNotNull())


def filter_available(df: DataFrame) -> DataFrame:
    return df.where("content_available")


def path_search(df: DataFrame, term: str) -> DataFrame:
    return df.where(F.contains("path", F.lit(term)))


def filter_source(df: DataFrame, source: str) -> DataFrame:
    return df.where(F.col("source") == source)


def misplaced_repo_paths(large: DataFrame) -> DataFrame:
    """Side-table rows whose repo_path is not below the large-file folder."""
    placed = F.startswith("repo_path", F.lit(C.LARGE_PREFIX))
    return large.where(~F.coalesce(placed, F.lit(False)))


def row_predicate(
    df: DataFrame,
    predicate: Column | Callable[[pd.DataFrame], pd.Series],
    columns: list[str] | None = None,
) -> DataFrame:
    """Keep rows for which a user predicate holds.

    Prefer a Column: it is optimised and pushed down. A Python function is called with
    Arrow batches of `columns` (all by default) and returns one boolean per row; name
    the columns it needs, so that content is not read for it.
    """
    if isinstance(predicate, Column):
        return df.where(predicate)

    @F.pandas_udf("boolean")
    def keep(rows: pd.DataFrame) -> pd.Series:
        return predicate(rows)

    return df.where(keep(F.struct(*(columns or df.columns))))
