"""Streaming ingest and deduplication over growing inputs."""

import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom.operators.manifest import dedupe_manifest
from paperloom.schema import MANIFEST
from paperloom.sources.archive import attach_content, plan_rows
from paperloom.streaming.batches import batch_process
from paperloom.streaming.ingest import _first_of_each, stream_dedupe, stream_files


def run(stream, out, checkpoint):
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(checkpoint))
    writer.trigger(availableNow=True).start(str(out)).awaitTermination()


def test_each_file_is_ingested_once(spark, tmp_path):
    root, out, checkpoint = (tmp_path / n for n in ("in", "out", "ck"))
    root.mkdir()

    def add(names):
        for name in names:
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_bytes(name.encode())

    def ingest():
        files = stream_files(spark, "s", str(root))
        rows = attach_content(plan_rows(files, max_bytes=4, chunk_bytes=3))
        run(rows.select("path", "chunk_index", "content"), out, checkpoint)
        return sorted((r.path, r.chunk_index, bytes(r.content)) for r in spark.read.parquet(str(out)).collect())

    def chunks(names):
        want = []
        for n in names:
            data = n.encode()
            size = 3 if len(data) > 4 else max(1, len(data))
            want += [(n, i, data[i * size:(i + 1) * size]) for i in range(-(-len(data) // size))]
        return sorted(want)

    add(["a", ".hid", "_u/abcdefg"])
    assert ingest() == chunks(["a", ".hid", "_u/abcdefg"])
    assert ingest() == chunks(["a", ".hid", "_u/abcdefg"])
    add(["late"])
    import os
    os.utime(root / "late", (1, 1))
    add(["a", "n/e/w"])
    assert ingest() == chunks(["a", ".hid", "_u/abcdefg", "late", "n/e/w"])


def test_stream_dedupe(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"i{i}", rng.choice(["p", "p", "q", None]), rng.choice(["m", "m", "n", None]), 1) for i in range(500)]
    source = tmp_path / "in"
    got = None
    for part in (rows[:200], rows[200:]):
        spark.createDataFrame(part, MANIFEST).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(MANIFEST).parquet(str(source))
        run(stream_dedupe(stream), tmp_path / "out", tmp_path / "ck")
        got = spark.read.parquet(str(tmp_path / "out")).collect()
    kept = dedupe_manifest(spark.createDataFrame(rows, MANIFEST))
    assert sorted(r.ord for r in got) == sorted(r.ord for r in kept.collect())
    pairs = [(r.path, r.md5) for r in got if r.md5 is not None]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(r[2], r[3]) for r in rows if r[3] is not None}
    assert sorted(r.ord for r in got if r.md5 is None) == [r[0] for r in rows if r[3] is None]


def test_state_of_pairs_that_stay_away_goes(spark, tmp_path):
    """Each run brings new pairs only; state never holds more than those of one run. (A query
    that has timeouts runs on, so it is stopped.)"""
    source, held = tmp_path / "in", []
    for k in range(3):
        rows = [(k * 100 + i, "i", f"p{k}", f"m{i}", 1) for i in range(50)]
        spark.createDataFrame(rows, MANIFEST).write.mode("append").parquet(str(source))
        stream = stream_dedupe(spark.readStream.schema(MANIFEST).parquet(str(source)), keep_days=1 / 86_400)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
        query = writer.trigger(processingTime="1 second").start(str(tmp_path / "out"))
        for _ in range(90):  # a query with timeouts never runs out of batches
            if sum(p.numInputRows for p in query.recentProgress) >= 50:
                break
            time.sleep(1)
        held.append(max(p.stateOperators[0].numRowsTotal for p in query.recentProgress))
        query.stop()
        time.sleep(2)
    assert held[0] == 50 and max(held) <= 100  # of 150: a batch drops what ran out before it
    assert spark.read.parquet(str(tmp_path / "out")).count() == 150


def test_sources_are_part_of_the_pair(spark, tmp_path):
    rows = [(i, "i", "p", "m", 1, s) for i, s in enumerate("abcab")]
    schema = "ord bigint, id string, path string, md5 string, size bigint, source string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    run(stream_dedupe(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), tmp_path / "out", tmp_path / "ck")
    assert sorted(r.ord for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2]


def test_batches_have_the_asked_size(spark):
    df = spark.range(0, 1050, 1, 4)

    def describe(batch):
        return batch.assign(n=len(batch)).iloc[:1][["n"]]

    sizes = [r.n for r in batch_process(df, describe, "n bigint", 100).collect()]
    assert sum(sizes) == 1050 and sorted(set(sizes)) == [62, 63, 100]
    assert df.select(F.count("*")).first()[0] == 1050


def test_batch_process_query_has_every_batch(spark, tmp_path):
    """A row per source and 20 numbered rows, not one per source."""
    rows = [(i, "x" * (i + 1), "en", "ab"[i % 3 // 2], i + 1) for i in range(90)] + [(90, None, "en", "a", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = entry.queries()["batch_process"](spark, str(tmp_path)).collect()
    assert {(r.source, r.batch): r.files for r in found} == {
        **{("a", k): 20 for k in range(3)}, ("a", 3): 1, ("b", 0): 20, ("b", 1): 10}
    assert sum(r.bytes or 0 for r in found) == sum(range(1, 91))


def test_dedupe_calls_no_python_per_pair(spark, tmp_path):
    """Pairs are remembered by Spark itself; rows of a pair that lie in several tasks and in
    several batches of a task give the one with the least `ord`."""
    spark.createDataFrame([], MANIFEST).write.parquet(str(tmp_path / "in"))
    plan = stream_dedupe(spark.readStream.schema(MANIFEST).parquet(str(tmp_path / "in")))._jdf.queryExecution().logical().toString()
    assert "Deduplicate" in plan and "PandasWithState" not in plan
    rows = [(i * 7 % 300, "i", f"p{i % 11}", "m", 1) for i in range(300)]
    batches = pa.Table.from_pylist([dict(zip(MANIFEST.fieldNames(), r)) for r in rows]).to_batches(max_chunksize=7)
    kept = pa.Table.from_batches(_first_of_each(["path", "md5"], 20)(iter(batches)))
    least = {}
    for r in rows:
        least[r[2]] = min(least.get(r[2], 300), r[0])
    assert dict(zip(kept["path"].to_pylist(), kept["ord"].to_pylist())) == least and len(kept) == 11
