"""Samples, positions and batches."""

from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom import constants as C
from paperloom.operators import sampling as O
from paperloom.registry import query
from paperloom.streaming.batches import batch_process

RUNNING_SQL = (
    B.ARCHIVE_SQL
    + f""",
running AS (
  SELECT *, count(*) FILTER (file_size <= {B.SAMPLE_MAX}) OVER (PARTITION BY source
      ORDER BY path, chunk_index ROWS UNBOUNDED PRECEDING) AS hits,
    row_number() OVER (PARTITION BY source ORDER BY path, chunk_index) - 1 AS pos
  FROM archive)"""
)


def _rows(spark, sf):
    return B.archive(spark, sf).drop("content")


@query(
    "bounded_sample",
    f"""WITH {RUNNING_SQL} SELECT source, path, chunk_index, file_size FROM running
    WHERE file_size <= {B.SAMPLE_MAX} AND hits <= {B.SAMPLE}""",
)
def bounded_sample(spark, sf):
    sample = O.bounded_sample(_rows(spark, sf), B.SAMPLE, B.SAMPLE_MAX)
    return sample.select("source", "path", "chunk_index", "file_size")


SAMPLE_STATS_SQL = f"""
SELECT source,
  CAST(count(*) FILTER (file_size <= {B.SAMPLE_MAX}) AS BIGINT) AS sampled,
  CAST(count(*) FILTER (file_size > {B.SAMPLE_MAX}) AS BIGINT) AS skipped,
  CAST(count(*) AS BIGINT) AS checked
FROM running
WHERE hits < {B.SAMPLE} OR (hits = {B.SAMPLE} AND file_size <= {B.SAMPLE_MAX}) GROUP BY source"""


@query("sample_stats", f"WITH {RUNNING_SQL} {SAMPLE_STATS_SQL}")
def sample_stats(spark, sf):
    return O.sample_stats(_rows(spark, sf), B.SAMPLE, B.SAMPLE_MAX)


def _top(column: str) -> str:
    return f"""WITH {B.FILES_SQL} SELECT source, {column}, files, rank FROM (
      SELECT source, {column}, CAST(count(*) AS BIGINT) AS files, CAST(row_number() OVER (
        PARTITION BY source ORDER BY count(*) DESC, {column}) AS BIGINT) AS rank
      FROM files GROUP BY source, {column}) WHERE rank <= 5"""


@query("top_types", _top("file_type"))
def top_types(spark, sf):
    return O.top_values(B.files(spark, sf), "file_type")


@query("top_extensions", _top("extension"))
def top_extensions(spark, sf):
    return O.top_values(B.files(spark, sf), "extension")


@query(
    "head_rows",
    f"WITH {B.ARCHIVE_SQL} SELECT source, path, chunk_index, file_size FROM archive "
    "ORDER BY source, path, chunk_index LIMIT 5",
)
def head_rows(spark, sf):
    return O.head_rows(_rows(spark, sf).select("source", "path", "chunk_index", "file_size"), 5)


@query(
    "select_positions",
    f"""WITH {RUNNING_SQL} SELECT source, path, chunk_index, CAST(pos AS BIGINT) AS position
    FROM running WHERE pos IN (0, 10, 20)""",
)
def select_positions(spark, sf):
    rows = _rows(spark, sf).select("source", "path", "chunk_index")
    return O.select_positions(rows, [0, 10, 20])


BATCHES_SQL = f"""WITH {RUNNING_SQL} SELECT source, CAST(pos // 20 AS BIGINT) AS batch,
      CAST(count(*) AS BIGINT) AS files, CAST(sum(file_size) AS BIGINT) AS bytes
    FROM running GROUP BY source, pos // 20"""


@query("batch_numbers", BATCHES_SQL)
def batches(spark, sf):
    rows = _rows(spark, sf).select("source", "path", "chunk_index", "file_size")
    return O.batch_numbers(rows, 20).groupBy("source", "batch").agg(
        F.count("*").alias("files"), F.sum("file_size").alias("bytes")
    )


@query("batch_process", BATCHES_SQL)
def batch_process_numbered(spark, sf):
    """Numbered rows handed to a function in batches; what it returns is summed by number."""
    def measure(rows):
        return rows[["source", "batch"]].assign(files=1, bytes=rows["file_size"])

    rows = _rows(spark, sf).select("source", "path", "chunk_index", "file_size")
    found = batch_process(O.batch_numbers(rows, 20), measure, "source string, batch bigint, files bigint, bytes bigint")
    return found.groupBy("source", "batch").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))


@query(
    "batch_sizes",
    f"""WITH {B.ARCHIVE_SQL} SELECT source, CAST(count(*) AS BIGINT) AS rows, CAST(sum(nbytes) AS BIGINT) AS bytes, true AS within_size
    FROM archive GROUP BY source""",
)
def batch_function_over_rows(spark, sf):
    """A function over batches of 100 rows with their content; what it returns is summed."""
    def measure(rows):
        sizes = rows["content"].map(len)
        return rows[["source"]].assign(bytes=sizes, batch=len(rows))

    found = batch_process(B.archive(spark, sf).select("source", "content"), measure, "source string, bytes bigint, batch bigint")
    return found.groupBy("source").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"),
                                       (F.max("batch") <= C.BATCH_ROWS).alias("within_size"))


@query(
    "batch_function",
    """SELECT doc_id, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS lines
    FROM documents""",
)
def batch_function(spark, sf):
    def count_lines(rows):
        return rows[["doc_id"]].assign(lines=rows["text"].str.count("\n") + 1)

    documents = B.table(spark, sf, "documents").select("doc_id", "text")
    return batch_process(documents, count_lines, "doc_id bigint, lines bigint")
