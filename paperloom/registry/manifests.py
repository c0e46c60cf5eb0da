"""Manifest operators."""

from paperloom import bindings as B
from paperloom.operators import manifest as O
from paperloom.registry import query

FIRSTS_SQL = (
    B.MANIFEST_SQL
    + """,
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY path, md5 ORDER BY ord) AS rn FROM manifest)
  WHERE md5 IS NULL OR rn = 1),
conflicts AS (
  SELECT path, CAST(count(DISTINCT md5) AS BIGINT) AS md5_count, min(ord) AS first_ord
  FROM manifest WHERE md5 IS NOT NULL AND path IS NOT NULL
  GROUP BY path HAVING count(DISTINCT md5) > 1)"""
)

STATS_SQL = """SELECT CAST((SELECT count(*) FROM manifest) AS BIGINT) AS entries_before,
  CAST((SELECT count(*) FROM firsts) AS BIGINT) AS entries_after,
  CAST((SELECT count(*) FROM manifest) - (SELECT count(*) FROM firsts) AS BIGINT) AS duplicates_removed,
  CAST((SELECT count(*) FROM manifest WHERE md5 IS NULL) AS BIGINT) AS md5_missing_entries,
  CAST((SELECT count(*) FROM conflicts) AS BIGINT) AS conflicting_paths"""


@query("dedupe_manifest", f"WITH {FIRSTS_SQL} SELECT ord, id, path, md5, size FROM firsts")
def dedupe_manifest(spark, sf):
    return O.dedupe_manifest(B.manifest(spark, sf))


@query("dedupe_stats", f"WITH {FIRSTS_SQL} {STATS_SQL}")
def dedupe_stats(spark, sf):
    return O.dedupe_stats(B.manifest(spark, sf))


@query("conflict_paths", f"WITH {FIRSTS_SQL} SELECT * FROM conflicts")
def conflict_paths(spark, sf):
    return O.conflict_paths(B.manifest(spark, sf))


@query(
    "conflict_md5s",
    f"""WITH {FIRSTS_SQL} SELECT path, md5, min(ord) AS first_ord FROM manifest
    WHERE md5 IS NOT NULL AND path IN (SELECT path FROM conflicts) GROUP BY path, md5""",
)
def conflict_md5s(spark, sf):
    return O.conflict_md5s(B.manifest(spark, sf))


CONFLICT_SAMPLE_SQL = f"""WITH {FIRSTS_SQL},
    sample AS (SELECT path, first_ord FROM conflicts ORDER BY first_ord LIMIT 20)
    SELECT s.first_ord AS path_ord, m.path, m.md5, min(m.ord) AS first_ord
    FROM manifest m JOIN sample s ON m.path = s.path
    WHERE m.md5 IS NOT NULL GROUP BY s.first_ord, m.path, m.md5"""


@query("conflict_sample", CONFLICT_SAMPLE_SQL)
def conflict_sample(spark, sf):
    return O.conflict_sample(B.manifest(spark, sf))


@query(
    "skipped_duplicates",
    f"""WITH {B.MANIFEST_SQL}
    SELECT CAST(count(*) - count(DISTINCT path || ' ' || md5) AS BIGINT) AS skipped_duplicates
    FROM manifest WHERE md5 IS NOT NULL""",
)
def skipped_duplicates(spark, sf):
    return O.skipped_duplicates(B.manifest(spark, sf))


BY_SOURCE_SQL = (
    B.SOURCES_SQL
    + """,
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY source, path, md5 ORDER BY ord) AS rn FROM entries)
  WHERE md5 IS NULL OR rn = 1),
conflicts AS (
  SELECT source, path, CAST(count(DISTINCT md5) AS BIGINT) AS md5_count, min(ord) AS first_ord
  FROM entries WHERE md5 IS NOT NULL AND path IS NOT NULL
  GROUP BY source, path HAVING count(DISTINCT md5) > 1)"""
)


@query("dedupe_manifest_by_source", f"WITH {BY_SOURCE_SQL} SELECT ord, id, path, md5, size, source FROM firsts")
def dedupe_manifest_by_source(spark, sf):
    return O.dedupe_manifest(B.manifest_of_sources(spark, sf))


@query("dedupe_stats_by_source", f"WITH {BY_SOURCE_SQL} {STATS_SQL.replace('manifest', 'entries')}")
def dedupe_stats_by_source(spark, sf):
    return O.dedupe_stats(B.manifest_of_sources(spark, sf))


@query(
    "conflict_md5s_by_source",
    f"""WITH {BY_SOURCE_SQL} SELECT e.source, e.path, e.md5, min(e.ord) AS first_ord
    FROM entries e JOIN conflicts c ON c.source = e.source AND c.path = e.path
    WHERE e.md5 IS NOT NULL GROUP BY e.source, e.path, e.md5""",
)
def conflict_md5s_by_source(spark, sf):
    return O.conflict_md5s(B.manifest_of_sources(spark, sf))


@query(
    "conflict_sample_by_source",
    f"""WITH {BY_SOURCE_SQL},
    sample AS (SELECT source, path, first_ord FROM conflicts ORDER BY first_ord, source, path LIMIT 20)
    SELECT s.first_ord AS path_ord, e.source, e.path, e.md5, min(e.ord) AS first_ord
    FROM entries e JOIN sample s ON e.source = s.source AND e.path = s.path
    WHERE e.md5 IS NOT NULL GROUP BY ALL""",
)
def conflict_sample_by_source(spark, sf):
    return O.conflict_sample(B.manifest_of_sources(spark, sf))


@query(
    "skipped_duplicates_by_source",
    f"""WITH {B.SOURCES_SQL}
    SELECT CAST(count(*) - count(DISTINCT source || ' ' || path || ' ' || md5) AS BIGINT) AS skipped_duplicates
    FROM entries WHERE md5 IS NOT NULL""",
)
def skipped_duplicates_by_source(spark, sf):
    return O.skipped_duplicates(B.manifest_of_sources(spark, sf))


STATUS_SQL = (
    B.ON_DISK_SQL
    + """,
verified AS (
  SELECT e.*, CASE WHEN d.path IS NULL THEN 'missing'
    WHEN e.size IS NOT NULL AND e.size <> d.file_size THEN 'size_mismatch'
    WHEN e.md5 IS NOT NULL AND e.md5 <> d.md5 THEN 'md5_mismatch' ELSE 'ok' END AS status
  FROM expected e LEFT JOIN on_disk d ON e.path = d.path)"""
)


@query("verify_manifest", f"WITH {STATUS_SQL} SELECT * FROM verified")
def verify_manifest(spark, sf):
    return O.verify_manifest(B.files_manifest(spark, sf), B.on_disk(spark, sf))


@query(
    "failed_sample",
    f"""WITH {STATUS_SQL} SELECT ord, path, status,
      CAST((SELECT count(*) FROM verified WHERE status <> 'ok') AS BIGINT) AS failed_total
    FROM verified WHERE status <> 'ok' ORDER BY ord LIMIT 10""",
)
def failed_sample(spark, sf):
    return O.failed_sample(verify_manifest(spark, sf))


@query("fetch_plan", f"WITH {STATUS_SQL} SELECT * EXCLUDE (status) FROM verified WHERE status <> 'ok'")
def fetch_plan(spark, sf):
    return O.fetch_plan(B.files_manifest(spark, sf), B.on_disk(spark, sf))


@query(
    "fetch_plan_present_only",
    f"""WITH {STATUS_SQL} SELECT * EXCLUDE (status) FROM verified WHERE status = 'missing'""",
)
def fetch_plan_present_only(spark, sf):
    return O.fetch_plan(B.files_manifest(spark, sf), B.on_disk(spark, sf), verify=False)


@query("fetch_plan_overwrite", f"WITH {FIRSTS_SQL} SELECT ord, id, path, md5, size FROM firsts")
def fetch_plan_overwrite(spark, sf):
    return O.fetch_plan(B.manifest(spark, sf), B.on_disk(spark, sf), overwrite=True)
