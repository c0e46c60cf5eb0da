"""Joins, the folder tree and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import archive as O
from paperloom.operators.validation import missing_subsets, schema_diff
from paperloom.plans.tree import tree_paths
from paperloom.registry import query
from paperloom.schema import ARCHIVE

JOINED_SQL = (
    B.PUBLISHED_SQL
    + f""",
joined AS (
  SELECT p.*, l.file_id, l.repo_path FROM published p LEFT JOIN (
    SELECT md5(source || '/' || path) AS file_id, source, path,
      'large_files/' || source || '/' || path AS repo_path
    FROM files WHERE file_size > {B.MAX_FILE}) l
  ON p.source = l.source AND p.path = l.path)"""
)


@query("large_file_join", f"WITH {JOINED_SQL} SELECT source, path, file_size, file_id, repo_path FROM joined")
def large_file_join(spark, sf):
    joined = O.large_file_join(B.published(spark, sf), B.large_files(spark, sf))
    return joined.select("source", "path", "file_size", "file_id", "repo_path")


@query(
    "content_resolve",
    f"""WITH {JOINED_SQL}
    SELECT source, path, file_size, CASE WHEN content_available THEN 'embedded'
      WHEN repo_path IS NOT NULL THEN 'external' ELSE 'unavailable' END AS location,
      CASE WHEN NOT content_available THEN repo_path END AS repo_path,
      round(file_size / {C.MB}, 2) AS size_mb, round(file_size / {C.GB}, 2) AS size_gb
    FROM joined""",
)
def content_resolve(spark, sf):
    return O.content_resolve(B.published(spark, sf), B.large_files(spark, sf))


@query(
    "source_priority_resolve",
    """WITH existing AS (SELECT lang AS root, 'n' || doc_id AS name FROM documents
      UNION SELECT source, 'n' || doc_id FROM documents WHERE doc_id % 3 = 0),
    roots AS (SELECT DISTINCT lang AS root, CASE lang WHEN 'fr' THEN 1 ELSE 3 END AS priority FROM documents
      UNION SELECT DISTINCT source, 2 FROM documents)
    SELECT name, root, priority FROM (
      SELECT *, row_number() OVER (PARTITION BY name ORDER BY priority, root) AS rn
      FROM existing JOIN roots USING (root))
    WHERE rn = 1""",
)
def source_priority_resolve(spark, sf):
    documents = B.table(spark, sf, "documents")
    name = F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("name")
    existing = documents.select(F.col("lang").alias("root"), name).unionAll(
        documents.where("doc_id % 3 = 0").select(F.col("source").alias("root"), name)
    ).distinct()
    priority = F.when(F.col("lang") == "fr", 1).otherwise(3)
    roots = documents.select(F.col("lang").alias("root"), priority.alias("priority")).unionAll(
        documents.select(F.col("source").alias("root"), F.lit(2).alias("priority"))
    ).distinct()
    included = documents.select(name)
    return O.source_priority_resolve(included, existing, roots)


@query("tree_paths", f"WITH RECURSIVE {B.LISTING_SQL} SELECT id, path FROM tree WHERE NOT folder")
def tree(spark, sf):
    return tree_paths(B.listing(spark, sf)).select("id", "path")


@query(
    "tree_paths_direct",
    f"WITH {B.LISTING_SQL.split('tree(')[0].rstrip().rstrip(',')} "
    "SELECT id, name AS path FROM listing WHERE parent_id = 'n7' AND NOT folder",
)
def tree_direct(spark, sf):
    return tree_paths(B.listing(spark, sf), root_id="n7", recursive=False).select("id", "path")


@query(
    "concat_subsets",
    f"""WITH {B.FILES_SQL} SELECT source, path FROM files WHERE source IN ('src1', 'src2', 'src3')
    UNION ALL SELECT source, path FROM files WHERE source = 'src1'""",
)
def concat_subsets(spark, sf):
    rows = B.files(spark, sf).select("source", "path")
    return O.concat_subsets([rows.where(F.col("source") == s) for s in ("src1", "src2", "src3", "src1")])


SPLITS = {"train": ["src0", "src1", "src2", "src4"], "eval": ["src3", "src5"]}


@query(
    "train_eval_split",
    f"""WITH {B.FILES_SQL} SELECT source, path,
      CASE WHEN source IN ('src3', 'src5') THEN 'eval' ELSE 'train' END AS split
    FROM files WHERE source IN ('src0', 'src1', 'src2', 'src4', 'src3', 'src5')""",
)
def train_eval_split(spark, sf):
    return O.train_eval_split(B.files(spark, sf).select("source", "path"), SPLITS)


@query(
    "schema_diff",
    """SELECT s.source AS subset, d.* FROM (SELECT DISTINCT source FROM documents) s,
    (VALUES ('content', 'missing', 'error'), ('total_chunks', 'missing', 'error'),
      ('external_file', 'extra', 'warning')) d("column", kind, severity)""",
)
def schema_differences(spark, sf):
    return schema_diff(B.published(spark, sf), ARCHIVE)


@query(
    "missing_subsets",
    """SELECT DISTINCT source FROM (SELECT source FROM documents UNION ALL SELECT n_name FROM nation)
    WHERE source NOT IN (SELECT source FROM documents)""",
)
def missing(spark, sf):
    rows = B.table(spark, sf, "documents")
    nations = B.table(spark, sf, "nation").select(F.col("n_name").alias("source"))
    expected = reduce(DataFrame.unionAll, [rows.select("source"), nations])
    return missing_subsets(expected, rows)
