"""Checks of a published archive, and the verdict they add up to."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom import constants as C
from paperloom.functions.content import signature_matches
from paperloom.functions.paths import matches_any
from paperloom.functions.structure import CHECKS, is_sound
from paperloom.operators.sampling import bounded_sample, sample_stats, top_values
from paperloom.plans.staging import stage
from paperloom.schema import ARCHIVE_UNCHUNKED, LARGE_FILES
from paperloom.sources.footers import schemas_on_disk

def schema_diff(rows: DataFrame, expected: StructType, subset: str = "source") -> DataFrame:
    """Per subset, how its columns differ from `expected`.

    (subset, column, kind): a missing column is an error, an extra one or another type
    a warning. The columns come from the schema; only the subset names are read.
    """
    actual = {f.name: f.dataType for f in rows.schema}
    wanted = {f.name: f.dataType for f in expected}
    found = [(name, "missing") for name in wanted if name not in actual]
    found += [(name, "extra") for name in actual if name not in wanted]
    found += [(n, "type") for n in wanted if n in actual and actual[n] != wanted[n]]
    entries = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in found]
    empty = F.array().cast("array<struct<column:string,kind:string>>")
    return (
        rows.groupBy(F.col(subset).alias("subset"))
        .agg(F.count("*").alias("_n"))
        .select("subset", F.explode(F.array(*entries) if entries else empty).alias("d"))
        .select("subset", "d.*", F.when(F.col("d.kind") == "missing", "error").otherwise("warning").alias("severity"))
    )


def schema_diff_on_disk(footers: DataFrame, expected: StructType, large: StructType = LARGE_FILES) -> DataFrame:
    """Per subset, how the columns of its shards differ from `expected` on disk.

    (subset, column, kind, files, severity), from the footers of the shards
    (`sources.footers`): how many of them lack a column (an error), have one more, or have
    another type (warnings). The side table is compared with `large`. `source` may be
    missing: the folder says it.
    """
    def columns(schema: StructType) -> Column:
        return F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("wanted")) for f in schema])

    found = schemas_on_disk(footers)
    side = F.col("subset") == C.LARGE_SUBSET
    totals = footers.groupBy(F.col("source").alias("subset")).agg(F.count("*").alias("total"))
    wanted = totals.select("subset", "total", F.inline(F.when(side, columns(large)).otherwise(columns(expected))))
    have = found.groupBy("subset", "column").agg(F.sum("files").alias("files"))
    lacking = wanted.where((F.col("column") != "source") | side).join(have, ["subset", "column"], "left").select(
        "subset", "column", F.lit("missing").alias("kind"), (F.col("total") - F.coalesce("files", F.lit(0))).alias("files"))
    both = found.join(wanted, ["subset", "column"])
    mistyped = both.where("type <> wanted").groupBy("subset", "column").agg(F.sum("files").alias("files")).select(
        "subset", "column", F.lit("type").alias("kind"), "files")
    extra = have.join(wanted, ["subset", "column"], "left_anti").select("subset", "column", F.lit("extra").alias("kind"), "files")
    severity = F.when(F.col("kind") == "missing", "error").otherwise("warning")
    return lacking.where("files > 0").unionAll(mistyped).unionAll(extra).withColumn("severity", severity)


def missing_subsets(expected: DataFrame, rows: DataFrame, large: DataFrame | None = None) -> DataFrame:
    """Names in `expected(source)` with no row in the archive. The side table, if given,
    is a subset of its own."""
    names = rows.select("source")
    if large is not None:
        names = names.unionAll(large.limit(1).select(F.lit(C.LARGE_SUBSET)))
    present = names.groupBy("source").agg(F.count("*").alias("_n"))
    return expected.select("source").distinct().join(present, "source", "left_anti")


def large_file_rules(large: DataFrame) -> DataFrame:
    """Per source: side-table rows with a wrong repo_path, and rows claiming content."""
    placed = F.coalesce(F.startswith("repo_path", F.lit(C.LARGE_PREFIX)), F.lit(False))
    return large.groupBy("source").agg(
        F.count("*").alias("files"),
        F.count_if(~placed).alias("invalid_repo_path"),
        F.count_if("content_available").alias("content_available"),
    )


def unwanted_files(rows: DataFrame, patterns: list[str] = C.REPORT_EXCLUDES) -> DataFrame:
    """Per source: rows matching exclude patterns, and the first such path."""
    hit = matches_any(F.col("path"), patterns)
    return (
        rows.groupBy("source")
        .agg(F.count_if(hit).alias("unwanted"), F.min(F.when(hit, F.col("path"))).alias("example"))
        .where("unwanted > 0")
    )


def availability_ratio(rows: DataFrame) -> DataFrame:
    """Per source: rows with content, rows, and the percentage to one decimal."""
    available = F.count_if("content_available")
    return rows.groupBy("source").agg(
        available.alias("available"),
        F.count("*").alias("files"),
        F.round(available * F.lit(100.0) / F.count("*"), 1).alias("percent"),
    )


def content_probe(rows: DataFrame) -> DataFrame:
    """Per source and extension: PDF and image rows with content, and how many of them
    do not start with the bytes their extension requires. Looks at every file."""
    known = F.col("extension").isin(list(C.SIGNATURES))
    usable = signature_matches(F.col("extension"), F.col("content"))
    return (
        rows.where(known & F.col("content_available"))
        .where("chunk_index = 0 or chunk_index is null")
        .where(F.octet_length("content") > 0)
        .groupBy("source", "extension")
        .agg(F.count("*").alias("tested"), F.count_if(~usable).alias("unusable"))
    )


def structure_probe(rows: DataFrame) -> DataFrame:
    """Per source and extension: whole PDF and image files with content, how many of them
    are damaged by the structure of their container, and the first such path.

    Reads all their content, in the tasks that read the rows; chunks of larger files are
    left to `chunk_completeness` and `file_digests`.
    """
    whole = rows.where("content_available").where(F.col("extension").isin(list(CHECKS)))
    if "total_chunks" in rows.columns:
        whole = whole.where("total_chunks = 1 or total_chunks is null")
    found = whole.select("source", "extension", "path", "content").mapInArrow(
        _structures, "source string, extension string, path string, sound boolean")
    return found.groupBy("source", "extension").agg(
        F.count("*").alias("tested"), F.count_if(~F.col("sound")).alias("damaged"),
        F.min(F.when(~F.col("sound"), F.col("path"))).alias("example"))


def _structures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds = batch.column("extension").to_pylist()
        sound = [is_sound(k, c.as_buffer()) if c.is_valid else False for k, c in zip(kinds, batch.column("content"))]
        keys = [batch.column(c) for c in ("source", "extension", "path")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(sound, pa.bool_())], ["source", "extension", "path", "sound"])


def chunk_completeness(rows: DataFrame) -> DataFrame:
    """Per file: are its chunk indexes exactly 0..n-1, and do the bytes add up?

    Chunks are counted and summed where they are; their bytes are never brought
    together. A row without chunk columns is a whole file.
    """
    whole = {"chunk_index": F.coalesce("chunk_index", F.lit(0)), "total_chunks": F.coalesce("total_chunks", F.lit(1))}
    return (
        rows.withColumns(whole)
        .groupBy("source", "path", "chunk_index")
        .agg(
            F.count("*").alias("copies"),
            F.max("total_chunks").alias("total_chunks"),
            F.max("file_size").alias("file_size"),
            F.sum(F.octet_length("content").cast("bigint")).alias("bytes"),
        )
        .groupBy("source", "path")
        .agg(
            F.sum("copies").alias("chunks"),
            F.max("total_chunks").cast("bigint").alias("total_chunks"),
            F.max("file_size").alias("file_size"),
            F.sum("bytes").alias("bytes"),
            F.coalesce(
                (F.count("*") == F.max("total_chunks"))
                & (F.max("copies") == 1)
                & (F.min("chunk_index") == 0)
                & (F.max("chunk_index") == F.max("total_chunks") - 1)
                & (F.sum("bytes") == F.max("file_size")),
                F.lit(False),
            ).alias("complete"),
        )
    )


def _check(df: DataFrame, check: str, severity, detail, n: str, subset: str = "source") -> DataFrame:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(
        F.col(subset).cast("string").alias("subset"),
        F.lit(check).alias("check"),
        severity.alias("severity"),
        detail.cast("string").alias("detail"),
        F.col(n).cast("bigint").alias("n"),
    )


def validate_archive(
    rows: DataFrame,
    large: DataFrame,
    expected_subsets: DataFrame,
    exclude: list[str] = C.REPORT_EXCLUDES,
    sample_rows: int = C.SAMPLE_ROWS,
    max_bytes: int = C.SAMPLE_MAX_BYTES,
    expected_schema: StructType = ARCHIVE_UNCHUNKED,
    probe_content: bool = True,
    footers: DataFrame | None = None,
    probe_structure: bool = False,
) -> DataFrame:
    """All checks as one long table (subset, check, severity, detail, n).

    Errors and warnings appear only where something was found; `info` rows describe the
    sample. `validation_verdict` turns the table into a result. The sample and its
    counts are staged, as several checks read them; only the probes read content: the
    leading bytes of PDF and image files, or with `probe_structure` all of them. With
    `footers` (`sources.footers.shard_footers`) the schema is that of every shard on disk;
    without them it is that of `rows`.
    """
    meta = rows.drop("content")
    sample = stage(bounded_sample(meta, sample_rows, max_bytes))
    large_sample = large.withColumn("source", F.lit(C.LARGE_SUBSET))
    one = F.lit(1)
    none = F.lit(None)

    if footers is None:
        schema = schema_diff(rows, expected_schema).unionAll(
            schema_diff(large_sample, LARGE_FILES)
        ).withColumn("n", one)
    else:
        schema = schema_diff_on_disk(footers, expected_schema).withColumnRenamed("files", "n")
    stats = stage(sample_stats(meta, sample_rows, max_bytes, sample))
    rules = large_file_rules(large_sample)
    empty = meta.agg(F.count("*").alias("rows")).where("rows = 0").select(none.alias("source"), one.alias("n"))
    checks = [
        _check(empty, "no_subsets", "error", none, "n"),
        _check(missing_subsets(expected_subsets, rows, large).withColumn("n", one), "missing_subset", "warning", none, "n"),
        _check(schema, "schema", F.col("severity"), F.concat_ws(" ", "kind", "column"), "n", "subset"),
        _check(stats.where("sampled = 0"), "no_data", "error", none, "checked"),
        _check(rules.where("invalid_repo_path > 0"), "repo_path", "error", none, "invalid_repo_path"),
        _check(rules.where("content_available > 0"), "large_content", "warning", none, "content_available"),
        _check(unwanted_files(sample, exclude), "unwanted_files", "error", F.col("example"), "unwanted"),
        _check(stats, "sampled", "info", F.concat_ws("/", "skipped", "checked"), "sampled"),
        _check(availability_ratio(sample), "content_available", "info", F.col("percent"), "available"),
        _check(top_values(sample, "file_type"), "file_type", "info", F.col("file_type"), "files"),
        _check(top_values(sample, "extension"), "extension", "info", F.col("extension"), "files"),
    ]
    if probe_content:
        bad = content_probe(rows).where("unusable > 0")
        checks.append(_check(bad, "content", "warning", F.col("extension"), "unusable"))
    if probe_structure:
        bad = structure_probe(rows).where("damaged > 0")
        checks.append(_check(bad, "structure", "warning", F.concat_ws(" ", "extension", "example"), "damaged"))
    return reduce(DataFrame.unionAll, checks)


def validation_verdict(checks: DataFrame) -> DataFrame:
    """(success, errors, warnings): errors make it fail, warnings do not."""
    errors = F.count_if(F.col("severity") == "error")
    return checks.agg(
        (errors == 0).alias("success"),
        errors.alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )
