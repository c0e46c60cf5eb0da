"""Token counts as rollups that are maintained by deltas.

Totals by source, language and tokenizer version are sums of signed changes: documents come
with plus, go with minus, and a revision is both. Changes are committed in batches under an id;
a batch that is committed again changes nothing, so a job can be repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.tokens import encoder

KEYS = ["source", "lang", "version"]
TOTALS = "source string, lang string, version string, documents long, tokens long"


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as encode:
            for batch in batches:
                tokens = pa.array([len(encode(t.as_py())) for t in batch.column(3)], pa.int64())
                yield pa.record_batch([*batch.columns[:3], tokens], ["doc_id", "source", "lang", "tokens"])
    return count


def count_tokens(
    docs: DataFrame, version: str, tokenizer: str,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, source, lang, version, tokens) of every row. Null and empty texts have no
    tokens; null sources and languages are groups of their own; other columns are ignored."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = named.mapInArrow(_counter(tokenizer), "doc_id long, source string, lang string, tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(version).alias("version"), "tokens")


def inserted(counts: DataFrame) -> DataFrame:
    """Signed changes of new documents. Repeated rows count each time."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), "tokens")


def deleted(counts: DataFrame) -> DataFrame:
    """Signed changes of documents that go, from the counts they came with."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed changes of documents whose count, source, language or version changed."""
    return deleted(old).unionByName(inserted(new))


class Rollup:
    """Totals in a folder of the shared storage: one folder per committed batch.

    A batch is complete when Spark's success mark lies in its folder; what a failed job
    left is not read, and is replaced when the batch is committed again. Batches commute, so
    their order does not matter. Only one job may commit the same batch at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _matches(self, pattern: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(f.getPath().getParent().toString() for f in found or [])

    def _folder(self, batch: str) -> str:
        return f"{self.path}/batch-{quote(batch, safe='').replace('%', '=')}"

    def committed(self, batch: str) -> bool:
        return bool(self._matches(f"{self._folder(batch)}/_SUCCESS"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add signed changes (source, lang, version, documents, tokens); False if the batch
        was committed before. Changes are summed before they are shuffled and written, so a
        hot source is one row per task."""
        if self.committed(batch):
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        summed.where("documents <> 0 or tokens <> 0").write.mode("overwrite").parquet(self._folder(batch))
        return True

    def totals(self) -> DataFrame:
        """Sums of all committed batches, without groups that are empty again."""
        folders = self._matches(f"{self.path}/batch-*/_SUCCESS")
        if not folders:
            return self.spark.createDataFrame([], TOTALS)
        rows = self.spark.read.schema(TOTALS).parquet(*folders)
        summed = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.where("documents <> 0 or tokens <> 0")
