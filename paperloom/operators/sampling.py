"""Samples, top values and positions, per subset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.plans.ordering import row_positions
from paperloom.plans.staging import stage


def _first_per_source(rows: DataFrame, order: list, n: int) -> DataFrame:
    """First `n` rows of each source by a total order, with their 1-based `_rank`.

    Spark cuts every task's input to `n` rows per source before the shuffle (window
    group limit), so a dominating source stays cheap. That holds up to a threshold;
    above it positions come from a range-partitioned count. Either way a null source is
    a group of its own and ranks are bigint.
    """
    threshold = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n <= threshold:
        window = Window.partitionBy("source").orderBy(*order)
        ranked = rows.withColumn("_rank", F.row_number().over(window).cast("bigint"))
    else:
        named = rows.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        ranked = row_positions(named, ["_group"], order, "_at")
        ranked = ranked.withColumn("_rank", F.col("_at") + 1).drop("_at", "_group")
    return ranked.where(F.col("_rank") <= n)


def bounded_sample(
    rows: DataFrame, n: int = C.SAMPLE_ROWS, max_bytes: int | None = C.SAMPLE_MAX_BYTES
) -> DataFrame:
    """The first `n` rows per source in (path, chunk_index) with file_size <= max_bytes.

    A source named as the side table has no size limit.
    """
    if max_bytes is not None:
        within = F.col("file_size") <= max_bytes
        rows = rows.where(within | (F.col("source") == C.LARGE_SUBSET))
    return _first_per_source(rows, ["path", "chunk_index"], n).drop("_rank")


def sample_stats(
    rows: DataFrame,
    n: int = C.SAMPLE_ROWS,
    max_bytes: int = C.SAMPLE_MAX_BYTES,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Per source: rows sampled, rows skipped for their size before the sample was full,
    and rows looked at. `sample` is the result of bounded_sample, if at hand.

    The end of a full sample is one key per source; the large rows are compared with it
    where they are and only counts are shuffled.
    """
    keys = ["source", "path", "chunk_index", "file_size"]
    at = F.struct("path", "chunk_index")
    if sample is None:
        sample = bounded_sample(rows.select(keys), n, max_bytes)
    ends = stage(
        sample.groupBy("source").agg(F.count("*").alias("sampled"), F.max(at).alias("last"))
    )
    # The n-th hit ends the scan; a sample that never fills scans everything.
    skipped = F.col("sampled").isNull() | (F.col("sampled") < n) | (F.col("at") < F.col("last"))
    large = rows.where((F.col("file_size") > max_bytes) & (F.col("source") != C.LARGE_SUBSET))
    skips = (
        large.select("source", at.alias("at"))
        .join(ends, "source", "left")
        .where(skipped)
        .groupBy("source")
        .agg(F.count("*").alias("skipped"))
    )
    sampled_n, skipped_n = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("sampled", "skipped"))
    return ends.join(skips, "source", "full").select(
        "source",
        sampled_n.alias("sampled"),
        skipped_n.alias("skipped"),
        (sampled_n + skipped_n).alias("checked"),
    )


def top_values(rows: DataFrame, column: str, n: int = C.TOP_VALUES) -> DataFrame:
    """The `n` most frequent values of `column` per source; ties go to the smaller value."""
    counts = rows.groupBy("source", column).agg(F.count("*").alias("files"))
    ranked = _first_per_source(counts, [F.desc("files"), column], n)
    return ranked.select("source", column, "files", F.col("_rank").alias("rank"))


def head_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first `n` rows in (source, path, chunk_index)."""
    return rows.orderBy("source", "path", "chunk_index").limit(n)


def select_positions(rows: DataFrame, positions: list[int]) -> DataFrame:
    """Rows at 0-based positions of each source, with `position`."""
    first = _first_per_source(rows, ["path", "chunk_index"], max(positions) + 1)
    return (
        first.withColumn("position", F.col("_rank") - 1)
        .where(F.col("position").isin(positions))
        .drop("_rank")
    )


def batch_numbers(rows: DataFrame, size: int = C.BATCH_ROWS) -> DataFrame:
    """Add `batch`: rows of each source numbered in order and cut into batches of `size`."""
    numbered = row_positions(rows, ["source"], ["path", "chunk_index"], "_at")
    batch = F.floor(F.col("_at") / F.lit(size)).cast("bigint")
    return numbered.withColumn("batch", batch).drop("_at")
