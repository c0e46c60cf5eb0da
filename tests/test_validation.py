"""Checks and the verdict."""

from pyspark.sql import functions as F

from paperloom.operators import validation as V
from paperloom.operators.archive import content_chunks, source_priority_resolve
from paperloom.schema import ARCHIVE, ARCHIVE_UNCHUNKED, LARGE_FILES


def row(path, source="s", content=b"%PDF", ext=".pdf", kind="document", size=None, available=True, i=0, n=1):
    size = len(content) if size is None else size
    return (path, source, kind, size, ext, bytearray(content), available, i, n)


def large(path, repo_path, available):
    return (f"id-{path}", "s", path, 5, ".mp4", "video", repo_path, available)


def run(spark, rows, side, expected=("s",), **options):
    df = spark.createDataFrame(rows, ARCHIVE)
    names = spark.createDataFrame([(e,) for e in expected], "source string")
    checks = V.validate_archive(df, spark.createDataFrame(side, LARGE_FILES), names, expected_schema=ARCHIVE, **options)
    found = {(r.subset, r.check, r.severity, r.detail, r.n) for r in checks.collect()}
    return found, V.validation_verdict(checks).first()


def test_a_good_archive_passes(spark):
    found, verdict = run(spark, [row("a.pdf"), row("b.pdf")], [large("v", "large_files/v", False)])
    assert verdict.success and (verdict.errors, verdict.warnings) == (0, 0)
    assert ("s", "sampled", "info", "0/2", 2) in found
    assert ("s", "content_available", "info", "100.0", 2) in found


def test_every_kind_of_finding(spark):
    rows = [
        row("a.pdf"), row("x/dedupe_report.json", ext=".json", kind="text"), row("bad.pdf", content=b"nope"),
        row("big.pdf", source="big", size=10**9),
    ]
    side = [large("v", "large_files/v", None), large("w", None, True), large("u", "elsewhere/u", False)]
    found, verdict = run(spark, rows, side, expected=("s", "gone"))
    problems = {f for f in found if f[2] != "info"}
    assert problems == {
        ("gone", "missing_subset", "warning", None, 1),
        ("big", "no_data", "error", None, 1),
        ("s", "unwanted_files", "error", "x/dedupe_report.json", 1),
        ("large_files", "repo_path", "error", None, 2),
        ("large_files", "large_content", "warning", None, 1),
        ("s", "content", "warning", ".pdf", 1),
    }
    assert (verdict.success, verdict.errors, verdict.warnings) == (False, 3, 3)


def test_an_empty_archive_fails(spark):
    found, verdict = run(spark, [], [], expected=())
    assert found == {(None, "no_subsets", "error", None, 1)} and not verdict.success


def test_schema_differences(spark):
    df = spark.createDataFrame([row("a")], ARCHIVE).drop("content").withColumn("file_size", F.lit("1"))
    found = {(r.subset, r.column, r.kind, r.severity) for r in V.schema_diff(df, ARCHIVE_UNCHUNKED).collect()}
    assert found == {("s", "content", "missing", "error"), ("s", "chunk_index", "extra", "warning"),
                     ("s", "total_chunks", "extra", "warning"), ("s", "file_size", "type", "warning")}
    assert V.schema_diff(spark.createDataFrame([row("a")], ARCHIVE), ARCHIVE).isEmpty()


def test_chunk_completeness(spark):
    data = b"0123456789"
    whole = spark.createDataFrame([row("ok", content=data), row("small", content=b"12")], ARCHIVE)
    chunks = content_chunks(whole, 4, 4)
    rows = [tuple(r) for r in chunks.collect()]
    assert sorted((r[0], r[7], r[8], bytes(r[5])) for r in rows) == [
        ("ok", 0, 3, b"0123"), ("ok", 1, 3, b"4567"), ("ok", 2, 3, b"89"), ("small", 0, 1, b"12")]

    def named(name, drop=(), repeat=()):
        ok = [r for r in rows if r[0] == "ok"]
        return [(name, *r[1:]) for r in ok if r[7] not in drop] + [(name, *r[1:]) for r in ok if r[7] in repeat]

    damaged = rows + named("lost first", {0}) + named("lost last", {2}) + named("twice", (), {1}) + named(
        "swapped", {0}, {1})
    got = {r.path: r.complete for r in V.chunk_completeness(spark.createDataFrame(damaged, ARCHIVE)).collect()}
    assert got == {"ok": True, "small": True, "lost first": False, "lost last": False, "twice": False, "swapped": False}


def test_source_priority(spark):
    included = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "name string")
    existing = spark.createDataFrame([("r2", "a"), ("r1", "a"), ("r2", "b"), ("r1", "z")], "root string, name string")
    roots = spark.createDataFrame([("r1", 0), ("r2", 1)], "root string, priority int")
    got = sorted(map(tuple, source_priority_resolve(included, existing, roots).collect()))
    assert got == [("a", "r1", 0), ("b", "r2", 1)]
