"""Named folders to an archive in one call."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators.archive import archive_summary
from paperloom.plans.convert import convert, find_sources
from paperloom.plans.staging import stage
from paperloom.sources.archive import plan_rows, read_archive
from paperloom.sources.listing import list_files


def test_convert(spark, tmp_path):
    first, second, out = (tmp_path / n for n in ("first", "second", "out"))
    for root, name, files in ((first, "a", ["x.txt", "y.pdf", "dedupe_report.json"]), (second, "a", ["other"]),
                              (second, "b", ["z"]), (second, "unasked", ["q"])):
        for file in files:
            (root / name).mkdir(parents=True, exist_ok=True)
            (root / name / file).write_bytes(file.encode())
    (first / "empty").mkdir()
    (first / "b").write_text("a file, not a folder")
    include, roots = ["a", "b", "empty", "nowhere"], [str(first), str(second)]
    found = {r.name: r.root for r in find_sources(spark, include, roots).collect()}
    assert found == {"a": str(first), "b": str(second), "empty": str(first)}
    summary = convert(spark, include, roots, str(out), max_shard_bytes=5)
    assert sorted(map(tuple, summary.collect())) == [("a", 2, 10, 0, 2), ("b", 1, 1, 0, 1), ("empty", 0, 0, 0, 0)]
    assert {(r.source, r.path, bytes(r.content)) for r in read_archive(spark, str(out)).collect()} == {
        ("a", "x.txt", b"x.txt"), ("a", "y.pdf", b"y.pdf"), ("b", "z", b"z")}
    with pytest.raises(FileNotFoundError):
        convert(spark, ["nowhere"], roots, str(out))


def test_failed_files_are_counted_apart(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    for name in ("x", "y", "z"):
        (tmp_path / "in" / "a" / name).write_bytes(b"12345")
    rows = plan_rows(list_files(spark, {"a": str(tmp_path / "in" / "a")}), max_bytes=4, chunk_bytes=3)
    plan = stage(rows.select("source", "path", "chunk_index", F.lit(0).alias("shard")))
    failures = spark.createDataFrame([("a", "y", 0, "gone"), ("a", "y", 1, "gone")], "source string, path string, chunk_index int, error string")
    assert archive_summary(rows, plan, failures).first().asDict() == {
        "source": "a", "files": 2, "bytes": 10, "chunked_files": 2, "failed_files": 1, "shards": 1}
    summary = convert(spark, ["a"], [str(tmp_path / "in")], str(tmp_path / "out"), on_error="skip").first()
    assert summary.asDict() == {"source": "a", "files": 3, "bytes": 15, "chunked_files": 0, "failed_files": 0, "shards": 1}
