"""Operators over manifests: project, dedupe, conflicts, verify, plan fetches."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.plans.staging import stage


def manifest_project(listed: DataFrame) -> DataFrame:
    """Listed files with paths -> manifest rows; a size that is no number is null."""
    return listed.select("id", "path", "md5", F.col("size").try_cast("bigint").alias("size"))


def _keys(*tables: DataFrame) -> list[str]:
    """What names a file: its path, within its source if all tables know it."""
    return ["source", "path"] if all("source" in t.columns for t in tables) else ["path"]


def dedupe_manifest(manifest: DataFrame) -> DataFrame:
    """Keep the first of each (path, md5) in `ord`; rows without md5 are all kept. Rows
    of several folders carry `source`, which is then part of the key.

    An aggregate, not a window: copies are combined before the shuffle, so a pair
    repeated in a third of all rows costs one row per map task. A null path groups.
    """
    keys = [*_keys(manifest), "md5"]
    rest = [c for c in manifest.columns if c not in (*keys, "ord")]
    first = (
        manifest.where("md5 is not null")
        .groupBy(*keys)
        .agg(F.min(F.struct("ord", *rest)).alias("first"))
        .select(*keys, "first.*")
    )
    return first.select(manifest.columns).unionAll(manifest.where("md5 is null"))


def _path_md5_pairs(manifest: DataFrame) -> DataFrame:
    return (
        manifest.where("path is not null and md5 is not null")
        .groupBy(*_keys(manifest), "md5")
        .agg(F.min("ord").alias("first_ord"))
    )


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join rows of one file; a null source is a source like any other."""
    keys = _keys(left, right)
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(named[f"_{k}"]) for k in keys])
    return left.join(named, same, how).drop(*[f"_{k}" for k in keys])


def conflict_paths(manifest: DataFrame) -> DataFrame:
    """Files with several md5s: ([source,] path, md5_count, first_ord)."""
    return (
        _path_md5_pairs(manifest)
        .groupBy(*_keys(manifest))
        .agg(F.count("*").alias("md5_count"), F.min("first_ord").alias("first_ord"))
        .where("md5_count > 1")
    )


def conflict_md5s(manifest: DataFrame) -> DataFrame:
    """Every md5 of the conflicting files, one row each: ([source,] path, md5, first_ord).

    One row per md5 instead of a list per path: a single path may have any number.
    """
    return _same(_path_md5_pairs(manifest), conflict_paths(manifest).drop("md5_count", "first_ord"), "left_semi")


def conflict_sample(manifest: DataFrame, n: int = C.CONFLICT_SAMPLE_ROWS) -> DataFrame:
    """The first `n` conflicting files in order of appearance, with all their md5s."""
    keys = _keys(manifest)
    first = (
        conflict_paths(manifest)
        .orderBy("first_ord", *keys)
        .limit(n)
        .select(*keys, F.col("first_ord").alias("path_ord"))
    )
    # At most n rows, so the broadcast is bounded and filters before the aggregate.
    return (
        _same(manifest.where("md5 is not null"), F.broadcast(first), "inner")
        .groupBy("path_ord", *keys, "md5")
        .agg(F.min("ord").alias("first_ord"))
    )


def dedupe_stats(manifest: DataFrame) -> DataFrame:
    """entries_before, entries_after, duplicates_removed, md5_missing_entries, conflicting_paths.

    Counts per file and md5, then per file, then overall: every step combines before it
    shuffles and the manifest is read once. What names a file is as in dedupe_manifest.
    """
    pair, keys = F.col("md5").isNotNull(), _keys(manifest)
    return (
        manifest.groupBy(*keys, "md5")
        .agg(F.count("*").alias("n"))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.count_if(pair).alias("pairs"),
            F.sum(F.when(~pair, F.col("n")).otherwise(0)).alias("missing"),
        )
        .agg(
            _total("n").alias("entries_before"),
            _total("pairs", "missing").alias("entries_after"),
            (_total("n") - _total("pairs", "missing")).alias("duplicates_removed"),
            _total("missing").alias("md5_missing_entries"),
            F.count_if(F.col("path").isNotNull() & (F.col("pairs") > 1)).alias("conflicting_paths"),
        )
    )


def _total(*names: str) -> Column:
    return sum((F.coalesce(F.sum(n), F.lit(0).cast("bigint")) for n in names[1:]),
               F.coalesce(F.sum(names[0]), F.lit(0).cast("bigint")))


def skipped_duplicates(manifest: DataFrame) -> DataFrame:
    """How many repeats of a file and md5 a fetch skips; entries without md5 never are."""
    return (
        manifest.where("md5 <> ''")
        .groupBy(*_keys(manifest), "md5")
        .agg(F.count("*").alias("n"))
        .agg((_total("n") - F.count("*")).alias("skipped_duplicates"))
    )


def _status(expected_size: Column, check_md5: bool) -> Column:
    """missing / size_mismatch / md5_mismatch / ok, in that order of precedence."""
    wrong_size = expected_size.isNotNull() & ~F.equal_null(expected_size, F.col("actual_size"))
    wrong_md5 = (F.col("md5") != "") & ~F.equal_null(F.col("md5"), F.col("actual_md5"))
    ladder = F.when(F.col("present").isNull(), "missing").when(wrong_size, "size_mismatch")
    if check_md5:
        ladder = ladder.when(wrong_md5, "md5_mismatch")
    return ladder.otherwise("ok")


def _with_actual(manifest: DataFrame, actual: DataFrame) -> DataFrame:
    """Left join with the files on disk, where a path is unique in its source.

    Both sides are joined by source and path if both have a source, else by path alone.

    A path repeated in a large part of the manifest is a skewed left side, which
    adaptive execution splits since the right side has one row per path.
    """
    keys = _keys(manifest, actual)
    found = actual.select(
        *keys,
        F.col("file_size").alias("actual_size"),
        F.col("md5").alias("actual_md5"),
        F.lit(True).alias("present"),
    )
    return manifest.join(found, keys, "left")


def verify_manifest(manifest: DataFrame, actual: DataFrame, check_md5: bool = True) -> DataFrame:
    """Add `status` to each manifest row by comparing it with the file at its path.

    `actual` has path, file_size, md5. A null or zero size and a null or empty md5
    are not checked.
    """
    expected = F.nullif(F.col("size"), F.lit(0).cast("bigint"))
    return (
        _with_actual(manifest, actual)
        .withColumn("status", _status(expected, check_md5))
        .select(*manifest.columns, "status")
    )


def failed_sample(verified: DataFrame, n: int = C.FAILED_SAMPLE_ROWS) -> DataFrame:
    """The first `n` failed files in manifest order, each with the total of failures. They
    are staged: verifying may mean reading every byte."""
    keys = _keys(verified)
    failed = stage(verified.where("status <> 'ok'").select("ord", *keys, "status"))
    total = failed.agg(F.count("*")).scalar()
    return (
        failed.orderBy("ord", *keys).limit(n).select("ord", *keys, "status", total.alias("failed_total"))
    )


def fetch_plan(
    manifest: DataFrame, actual: DataFrame, overwrite: bool = False, verify: bool = True
) -> DataFrame:
    """Manifest rows whose file still has to be fetched.

    Repeats of a (path, md5) are fetched once, even with `overwrite`. Without
    `overwrite` a file already there is left alone: when it verifies, or always if
    `verify` is off. Unlike verify_manifest, an expected size of zero is checked.
    """
    wanted = dedupe_manifest(manifest.withColumn("md5", F.nullif("md5", F.lit(""))))
    if overwrite:
        return wanted
    if not verify:
        return wanted.join(actual.select(keys := _keys(wanted, actual)), keys, "left_anti")
    status = _status(F.col("size"), check_md5=True)
    return _with_actual(wanted, actual).where(status != "ok").select(*manifest.columns)
