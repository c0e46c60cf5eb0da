"""Structured Streaming queries, run over the whole table and read back."""

from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom.plans.staging import scratch_path
from paperloom.registry import query
from paperloom.registry.manifests import FIRSTS_SQL
from paperloom.sources.export import file_export
from paperloom.streaming.ingest import stream_dedupe, stream_files


def _run(stream, out: str, checkpoint: str) -> None:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()


@query(
    "stream_ingest",
    f"WITH {B.FILES_SQL} SELECT source || '/' || path AS path, file_size FROM files",
)
def stream_ingest(spark, sf):
    """The tree grows between two runs; each file is ingested once."""
    tree, out, checkpoint = (scratch_path(spark, n) for n in ("tree", "ingested", "checkpoint"))
    rows = B.scannable(spark, sf)
    first = F.col("file_type") == "image"
    for arriving in (rows.where(first), rows.where(~first)):
        file_export(arriving, tree, scratch_path(spark, "receipts"))
        _run(stream_files(spark, "docs", tree), out, checkpoint)
    return spark.read.parquet(out).select("path", "file_size")


@query(
    "stream_dedupe",
    f"WITH {FIRSTS_SQL} SELECT ord, id, path, md5, size FROM firsts",
)
def dedupe(spark, sf):
    """A manifest that grows at its end, in three batches: what stays is what stays of the whole."""
    listed, out, checkpoint = (scratch_path(spark, n) for n in ("listed", "deduped", "checkpoint"))
    rows = B.manifest(spark, sf)
    third = rows.agg(F.max("ord")).first()[0] // 3 + 1
    for k in range(3):
        rows.where(F.col("ord").between(k * third, (k + 1) * third - 1)).write.mode("append").parquet(listed)
        _run(stream_dedupe(spark.readStream.schema(rows.schema).parquet(listed)), out, checkpoint)
    return spark.read.parquet(out)
