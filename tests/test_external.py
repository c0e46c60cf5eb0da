"""Large files kept outside the archive, and the side table that locates them."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators.archive import (
    content_resolve,
    embedded_vs_external,
    large_files_build,
    subset_sizes,
    train_eval_split,
)
from paperloom.operators.filters import row_predicate
from paperloom.schema import ARCHIVE, LARGE_FILES
from paperloom.sources import archive
from paperloom.sources.content import load_content
from paperloom.sources.export import large_files_publish
from paperloom.sources.listing import list_files
from paperloom.sources.shards import archive_write

SIZES = {"small.txt": 10, "a/video.mp4": 2500, "b/video.mp4": 1001, "edge.mov": 1000, "empty": 0}


@pytest.fixture
def repo(spark, tmp_path):
    contents = {}
    for source in ("s1", "s2"):
        for name, size in SIZES.items():
            data = (source + name).encode() * size
            file = tmp_path / source / name
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_bytes(data[:size])
            contents[source, name] = data[:size]
    listed = list_files(spark, {s: str(tmp_path / s) for s in ("s1", "s2")})
    rows = archive.plan_rows(listed, large="external", max_bytes=1000)
    out = str(tmp_path / "repo")
    side = large_files_build(rows, 1000)
    return listed, rows, side, out, contents


@pytest.mark.parametrize("partitioned", [True, False])
def test_bytes_are_found_wherever_they_are(spark, repo, tmp_path, partitioned):
    listed, rows, side, out, contents = repo
    archive_write(rows, out, 1500, partitioned)
    archive.large_files_write(side, out)
    copied = large_files_publish(listed, side, out, str(tmp_path / "receipts")).collect()
    assert sorted((r.source, r.path, r.written) for r in copied) == [
        (s, n, SIZES[n]) for s in ("s1", "s2") for n in ("a/video.mp4", "b/video.mp4")]

    back = archive.read_archive(spark, out, partitioned)
    assert back.count() == len(contents)
    large = archive.large_files_scan(spark, out)
    assert large.schema.simpleString() == LARGE_FILES.simpleString() and large.count() == 4
    loaded = {}
    for r in load_content(back, large, out, chunk_bytes=700).orderBy("chunk_index").collect():
        assert r.read_error is None
        assert r.location == ("external" if SIZES[r.path] > 1000 else "embedded")
        loaded[r.source, r.path] = loaded.get((r.source, r.path), b"") + bytes(r.content)
    assert loaded == contents

    subsets = archive.all_subsets_scan(spark, out, partitioned)
    assert {n: df.count() for n, df in subsets.items()} == {"large_files": 4, "s1": 5, "s2": 5}

    where = {(r.source, r.path): (r.location, r.repo_path) for r in content_resolve(back, large).collect()}
    assert where["s1", "a/video.mp4"] == ("external", "large_files/s1/a/video.mp4")
    assert where["s2", "edge.mov"] == ("embedded", None)


def test_unavailable_content(spark, repo):
    _, rows, side, out, _ = repo
    stored = rows.withColumn("content", F.lit(None).cast("binary")).select(ARCHIVE.fieldNames())
    nothing = load_content(stored, side.limit(0), out).where("location = 'unavailable'").collect()
    assert {(r.path, r.read_error) for r in nothing} == {
        ("a/video.mp4", "content not available"), ("b/video.mp4", "content not available")}


def test_counts(spark, repo):
    _, rows, side, _, _ = repo
    located = rows.join(side.select("source", "path", F.col("repo_path").alias("external_file")), ["source", "path"], "left")
    got = embedded_vs_external(located).first().asDict()
    assert got == {"files": 10, "embedded_files": 6, "external_files": 4, "embedded_bytes": 2020, "external_bytes": 7002}
    assert embedded_vs_external(located.limit(0)).first().asDict() == dict.fromkeys(got, 0)
    sizes = {r.subset: (r.files, r.bytes) for r in subset_sizes(rows, side).collect()}
    assert sizes == {"s1": (5, 4511), "s2": (5, 4511), "large_files": (4, 7002)}


def test_splits_and_predicates(spark, repo):
    _, rows, *_ = repo
    split = train_eval_split(rows, {"train": ["s1"], "eval": ["s2", "other"]})
    assert {(r.source, r.split) for r in split.collect()} == {("s1", "train"), ("s2", "eval")}
    by_column = row_predicate(rows, F.col("file_size") > 1000)
    by_function = row_predicate(rows, lambda batch: batch["file_size"] > 1000, ["file_size"])
    assert sorted(by_column.collect()) == sorted(by_function.collect()) and by_column.count() == 4
