"""Aggregates and shard plans."""

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import archive as O
from paperloom.operators.validation import availability_ratio
from paperloom.plans.packing import assign_shards
from paperloom.registry import query
from paperloom.sources.shards import row_bytes

SHARDS_SQL = (
    B.ARCHIVE_SQL
    + f""",
ordered AS (
  SELECT source, path, chunk_index, nbytes,
    row_number() OVER (PARTITION BY source ORDER BY path, chunk_index) AS rn FROM archive),
walk(source, rn, path, chunk_index, nbytes, shard, running) AS (
  SELECT source, rn, path, chunk_index, nbytes, 0, nbytes FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.source, o.rn, o.path, o.chunk_index, o.nbytes,
    CASE WHEN w.running >= {B.SHARD} THEN w.shard + 1 ELSE w.shard END,
    CASE WHEN w.running >= {B.SHARD} THEN o.nbytes ELSE w.running + o.nbytes END
  FROM walk w JOIN ordered o ON o.source = w.source AND o.rn = w.rn + 1),
shards AS (
  SELECT source, CAST(max(shard) + 1 AS BIGINT) AS shards FROM walk GROUP BY source),
planned AS (
  SELECT w.source, path, chunk_index, nbytes, shard, CAST(shards AS INT) AS shard_total,
    printf('%s-%05d-of-%05d.parquet', w.source, shard, shards) AS shard_file
  FROM walk w JOIN shards s ON w.source = s.source)"""
)


def shard_plan(spark, sf):
    return assign_shards(row_bytes(B.archive(spark, sf)), B.SHARD)


@query(
    "shard_assign",
    f"""WITH RECURSIVE {SHARDS_SQL}
    SELECT source, path, chunk_index, CAST(nbytes AS BIGINT) AS nbytes, CAST(shard AS INT) AS shard,
      shard_total, shard_file FROM planned""",
)
def shard_assign(spark, sf):
    return shard_plan(spark, sf)


@query("shard_totals", f"WITH RECURSIVE {SHARDS_SQL} SELECT * FROM shards")
def shard_totals(spark, sf):
    return O.shard_totals(shard_plan(spark, sf))


@query(
    "archive_summary",
    f"""WITH RECURSIVE {SHARDS_SQL}
    SELECT a.source, CAST(count(*) AS BIGINT) AS files, CAST(sum(file_size) AS BIGINT) AS bytes,
      CAST(count(*) FILTER (total_chunks > 1) AS BIGINT) AS chunked_files, any_value(shards) AS shards
    FROM archive a JOIN shards s ON a.source = s.source WHERE chunk_index = 0 GROUP BY a.source""",
)
def archive_summary(spark, sf):
    return O.archive_summary(B.archive(spark, sf), shard_plan(spark, sf))


@query(
    "count_by_source",
    f"WITH {B.FILES_SQL} SELECT source, CAST(count(*) AS BIGINT) AS files FROM files GROUP BY source",
)
def count_by_source(spark, sf):
    return O.count_by_source(B.files(spark, sf))


@query(
    "embedded_vs_external",
    f"""WITH {B.PUBLISHED_SQL} SELECT CAST(count(*) AS BIGINT) AS files,
      CAST(count(*) FILTER (content_available) AS BIGINT) AS embedded_files,
      CAST(count(external_file) AS BIGINT) AS external_files,
      CAST(coalesce(sum(file_size) FILTER (content_available), 0) AS BIGINT) AS embedded_bytes,
      CAST(coalesce(sum(file_size) FILTER (external_file IS NOT NULL), 0) AS BIGINT) AS external_bytes
    FROM published""",
)
def embedded_vs_external(spark, sf):
    return O.embedded_vs_external(B.published(spark, sf))


@query(
    "subset_sizes",
    f"""WITH {B.LARGE_SQL} SELECT subset, CAST(count(*) AS BIGINT) AS files,
      CAST(sum(file_size) AS BIGINT) AS bytes
    FROM (SELECT source AS subset, file_size FROM files
      UNION ALL SELECT 'large_files', file_size FROM large) GROUP BY subset""",
)
def subset_sizes(spark, sf):
    return O.subset_sizes(B.files(spark, sf), B.large_files(spark, sf))


@query(
    "archive_rollup",
    f"""WITH {B.FILES_SQL} SELECT source, CAST(count(*) AS BIGINT) AS files,
      CAST(sum(file_size) AS BIGINT) AS bytes, round(sum(file_size) / {C.GB}, 2) AS size_gb
    FROM files GROUP BY ROLLUP (source)""",
)
def archive_rollup(spark, sf):
    return O.archive_rollup(B.files(spark, sf))


@query(
    "modality_counts",
    f"WITH {B.FILES_SQL} SELECT file_type, CAST(count(*) AS BIGINT) AS files FROM files GROUP BY file_type",
)
def modality_counts(spark, sf):
    return O.modality_counts(B.files(spark, sf))


@query(
    "availability_ratio",
    f"""WITH {B.PUBLISHED_SQL} SELECT source, CAST(count(*) FILTER (content_available) AS BIGINT) AS available,
      CAST(count(*) AS BIGINT) AS files,
      round(count(*) FILTER (content_available) * 100.0 / count(*), 1) AS percent
    FROM published GROUP BY source""",
)
def availability(spark, sf):
    return availability_ratio(B.published(spark, sf))
