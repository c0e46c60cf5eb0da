"""Files in, archive, files out: on a hand-made tree with awkward names."""

import hashlib
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.operators import rewrite
from paperloom.operators.manifest import verify_manifest
from paperloom.operators.validation import chunk_completeness
from paperloom.schema import ARCHIVE
from paperloom.sources import archive
from paperloom.sources.content import files_on_disk
from paperloom.sources.export import file_export
from paperloom.sources.listing import list_files
from paperloom.sources.shards import archive_write, read_failures

LIMIT, CHUNK, SHARD = 100, 40, 120

TREE = {
    "a.JPG": 10, "ab.tar.gz": 10, "noext": 3, "dot.": 3, "empty.txt": 0, "_u.txt": 5, "_under/q.txt": 6,
    ".hidden": 4, ".DS_Store": 9, ".manifest.json": 9, ".manifest.json.bak.1": 9, "sub/__MACOSX/z.txt": 7,
    "dedupe_report.json": 8, "sp ace/p%20 é+x.pdf": 11, "under.bin": LIMIT - 1, "at.bin": LIMIT,
    "over.bin": LIMIT + 1, "deep/er/and/deeper/big.bin": 3 * LIMIT + 7,
}


def write_tree(root: Path) -> dict[str, bytes]:
    contents = {}
    for name, size in TREE.items():
        data = bytes((i * 31 + len(name)) % 256 for i in range(size))
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
        contents[name] = data
    return contents


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "my source=1"
    root.mkdir()
    return root, write_tree(root)


def kept(contents, patterns=C.CONVERT_EXCLUDES):
    return {n: d for n, d in contents.items() if not any(p in n for p in patterns)}


@pytest.mark.parametrize("budget", [1, 3, 20_000])
def test_listing_finds_every_file(spark, tree, budget):
    root, contents = tree
    rows = list_files(spark, {"s": str(root)}, entries_per_task=budget).collect()
    assert {r.path: r.file_size for r in rows} == {n: len(d) for n, d in contents.items()}
    assert len(rows) == len(contents)
    assert all(r.modified_us == os.stat(root / r.path).st_mtime_ns // 1000 for r in rows)


def test_listing_does_not_follow_folder_links(spark, tree):
    root, contents = tree
    (root / "loop").symlink_to(root)
    (root / "link.txt").symlink_to(root / "a.JPG")
    paths = {r.path for r in list_files(spark, {"s": str(root)}).collect()}
    assert paths == {*contents, "link.txt"}


def test_scan(spark, tree):
    root, contents = tree
    rows = archive.archive_scan(spark, {"s": f"file://{root}"} if " " not in str(root) else {"s": str(root)},
                                max_bytes=LIMIT, chunk_bytes=CHUNK)
    got = {}
    for r in rows.collect():
        assert r.read_error is None and r.content_available and r.source == "s"
        got.setdefault(r.path, []).append((r.chunk_index, r.total_chunks, bytes(r.content), r.file_size))
    want = kept(contents)
    assert set(got) == set(want)
    for name, data in want.items():
        chunks = sorted(got[name])
        n = 1 if len(data) <= LIMIT else -(-len(data) // CHUNK)
        assert [c[:2] for c in chunks] == [(i, n) for i in range(n)]
        assert b"".join(c[2] for c in chunks) == data
        assert all(c[3] == len(data) for c in chunks)
    assert rows.drop("read_error").schema.simpleString() == ARCHIVE.simpleString()


def test_scan_with_external_files(spark, tree):
    root, contents = tree
    rows = archive.archive_scan(spark, {"s": str(root)}, large="external", max_bytes=LIMIT).collect()
    assert {r.path for r in rows} == set(kept(contents))
    for r in rows:
        data = contents[r.path]
        assert r.content_available == (len(data) <= LIMIT)
        assert (bytes(r.content) if r.content is not None else None) == (data if r.content_available else None)


def test_unreadable_file_costs_only_itself(spark, tree):
    root, contents = tree
    listed = list_files(spark, {"s": str(root)})
    rows = archive.plan_rows(listed, max_bytes=LIMIT, chunk_bytes=CHUNK)
    (root / "a.JPG").unlink()
    read = archive.attach_content(rows).collect()
    assert {r.path for r in read if r.read_error} == {"a.JPG"}
    out = str(root.parent / "out")
    with pytest.raises(Exception, match="a.JPG"):
        archive_write(rows, out + "-fails", SHARD)
    assert not (Path(out + "-fails") / "_SUCCESS").exists()
    archive_write(rows, out, SHARD, on_error="skip")
    assert '"failed_rows": 1' in (Path(out) / "_SUCCESS").read_text()
    assert [(r.source, r.path) for r in read_failures(spark, out).collect()] == [("s", "a.JPG")]
    with pytest.raises(FileExistsError):
        archive_write(rows, out, SHARD, on_error="skip")
    written = {r.path for r in archive.read_archive(spark, out).select("path").distinct().collect()}
    assert written == set(kept(contents)) - {"a.JPG"}


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("located", [True, False])
def test_write_read_export(spark, tree, tmp_path, located, partitioned):
    root, contents = tree
    roots = {"my source=1": str(root), "x": str(root)}
    if located:
        rows = archive.plan_rows(list_files(spark, roots), max_bytes=LIMIT, chunk_bytes=CHUNK)
    else:
        rows = archive.archive_scan(spark, roots, max_bytes=LIMIT, chunk_bytes=CHUNK).drop("read_error")
    out = str(tmp_path / "archive")
    plan = archive_write(rows, out, SHARD, partitioned).collect()

    files = sorted(p.relative_to(out).as_posix() for p in Path(out).rglob("*.parquet"))
    assert {f.split("/")[-1] for f in files} == {r.shard_file for r in plan}
    total = plan[0].shard_total
    assert f"x-00000-of-{total:05d}.parquet" in {f.split("/")[-1] for f in files}
    assert not list(Path(out).rglob(".paperloom*"))

    back = archive.read_archive(spark, out, partitioned)
    assert back.schema.simpleString() == ARCHIVE.simpleString()
    assert back.where(~F.col("source").isin(list(roots))).isEmpty()
    assert all(r.complete for r in chunk_completeness(back).collect())
    one = archive.subset_scan(spark, out, "my source=1", partitioned)
    assert one.select("path").distinct().count() == len(kept(contents))
    found = {r.source: r.shards for r in archive.discover_subsets(spark, out).collect()}
    assert found == {s: total for s in roots}
    assert set(archive.all_subsets_scan(spark, out, partitioned)) == set(roots)

    exported = tmp_path / "exported"
    receipts = file_export(back, str(exported), str(tmp_path / "receipts")).collect()
    want = {f"{s}/{n}": d for s in roots for n, d in kept(contents).items()}
    assert {f"{r.source}/{r.path}": r.written for r in receipts} == {n: len(d) for n, d in want.items()}
    assert {p.relative_to(exported).as_posix(): p.read_bytes() for p in exported.rglob("*") if p.is_file()} == want


def test_single_shard_is_named_in_full(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.txt").write_bytes(b"x")
    rows = archive.plan_rows(list_files(spark, {"s": str(tmp_path / "in")}))
    archive_write(rows, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out").rglob("*.parquet")] == ["s-00000-of-00001.parquet"]


def test_an_empty_folder_is_an_archive_without_shards(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    listed = list_files(spark, {"s": str(tmp_path / "in")})
    assert archive_write(archive.plan_rows(listed), str(tmp_path / "out")).isEmpty()
    assert '"shards": 0' in (tmp_path / "out" / "_SUCCESS").read_text()
    assert archive.discover_subsets(spark, str(tmp_path / "out")).isEmpty()


@pytest.mark.parametrize("ranges", [1, 2, 65_536])
def test_shards_do_not_depend_on_the_ranges_of_tasks(spark, tree, tmp_path, monkeypatch, ranges):
    from paperloom.sources import shards

    root, _ = tree
    rows = archive.plan_rows(list_files(spark, {"s": str(root), "r": str(root)}), max_bytes=LIMIT, chunk_bytes=CHUNK)
    monkeypatch.setattr(shards, "MAX_RANGES", ranges)
    plan = archive_write(rows, str(tmp_path / "a"), SHARD)
    got = archive.scan_shards(spark, str(tmp_path / "a"))
    found = sorted((r.source, r.path, r.chunk_index) for r in got.collect())
    assert found == sorted((r.source, r.path, r.chunk_index) for r in plan.collect())
    for r in plan.groupBy("source", "shard_file").count().collect():
        file = tmp_path / "a" / f"source={r.source}" / r.shard_file
        assert pq.read_metadata(file).num_rows == r["count"]
        shard = pq.ParquetFile(file).read(columns=["path", "chunk_index"])
        keys = list(zip(*(shard.column(c).to_pylist() for c in ("path", "chunk_index"))))
        assert keys == sorted(keys)


@pytest.mark.parametrize("path", ["../x", "/etc/x", "a/../../x", ""])
def test_export_refuses_unsafe_paths(spark, tmp_path, path):
    row = (path, "s", "text", 1, ".txt", bytearray(b"x"), True, 0, 1)
    with pytest.raises(Exception, match="unsafe path"):
        file_export(spark.createDataFrame([row], ARCHIVE), str(tmp_path / "o"), str(tmp_path / "r"))
    assert not (tmp_path / "x").exists()


def test_verify_files_on_disk(spark, tree):
    root, contents = tree
    actual = files_on_disk(spark, {"s": str(root)})
    rows = [(i, n, n, hashlib.md5(d).hexdigest(), len(d)) for i, (n, d) in enumerate(contents.items())]
    rows.append((99, "lost", "lost", None, None))
    wanted = spark.createDataFrame(rows, "ord bigint, id string, path string, md5 string, size bigint")
    status = {r.path: r.status for r in verify_manifest(wanted, actual).collect()}
    assert status == {**dict.fromkeys(contents, "ok"), "lost": "missing"}


@pytest.mark.parametrize("partitioned", [True, False])
def test_filter_in_place(spark, tree, tmp_path, partitioned):
    root, contents = tree
    out = str(tmp_path / "archive")
    rows = archive.plan_rows(list_files(spark, {"s +%20": str(root)}), max_bytes=LIMIT, chunk_bytes=CHUNK)
    archive_write(rows, out, SHARD, partitioned)
    before = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(out).rglob("*.parquet")}

    dry = rewrite.filter_archive(spark, out, dry_run=True, partitioned=partitioned)
    assert dry.agg(F.sum("rows_removed")).first()[0] == 1
    assert {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(out).rglob("*.parquet")} == before

    counts = rewrite.filter_archive(spark, out, partitioned=partitioned)
    assert rewrite.removal_totals(counts).first().asDict() == {"files_modified": 1, "total_removed": 1}
    after = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in Path(out).rglob("*.parquet")}
    assert all(after[p] == before[p] for p in before) and len(set(after) - set(before)) == 1  # swapped by the log
    left = {r.path for r in archive.read_archive(spark, out, partitioned).select("path").distinct().collect()}
    assert left == set(kept(contents, [*C.CONVERT_EXCLUDES, "dedupe_report.json"]))
    again = rewrite.filter_archive(spark, out, partitioned=partitioned)
    assert rewrite.removal_totals(again).first().total_removed == 0


@pytest.mark.parametrize("partitioned", [True, False])
def test_edges_only_opens_first_and_last_shards(spark, tree, tmp_path, partitioned):
    root, _ = tree
    out = str(tmp_path / "archive")
    rows = archive.plan_rows(list_files(spark, {"s 1": str(root), "t": str(root)}), max_bytes=LIMIT, chunk_bytes=CHUNK)
    plan = archive_write(rows, out, SHARD, partitioned)
    ends = {(r.source, r.shard_file) for r in plan.where("shard in (0, shard_total - 1)").collect()}
    counts = rewrite.removed_rows(spark, out, edges_only=True, partitioned=partitioned)
    assert counts.count() == 4
    assert {(r.source, r.file.split("/")[-1].replace("%20", " ")) for r in counts.collect()} == ends
    assert rewrite.removed_rows(spark, out, partitioned=partitioned).count() > 4


def test_filter_edges_only(spark, tmp_path):
    from paperloom.operators.archive import edge_files

    files = spark.createDataFrame([("s", f"s-{i}") for i in (3, 1, 2)] + [("t", "t-1")], "source string, file string")
    assert sorted(map(tuple, edge_files(files).collect())) == [("s", "s-1"), ("s", "s-3"), ("t", "t-1")]


def test_external_limit_is_apart_from_the_row_size(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for name, size in (("small", 5), ("middle", 25), ("large", 45)):
        (tmp_path / "t" / name).write_bytes(b"x" * size)
    rows = archive.archive_scan(spark, {"s": str(tmp_path / "t")}, large="external", max_bytes=40, chunk_bytes=10, row_bytes=10).collect()
    found = {}
    for r in rows:
        found.setdefault(r.path, []).append((r.content_available, r.chunk_index, r.total_chunks, len(r.content or b"")))
    assert found["small"] == [(True, 0, 1, 5)] and found["large"] == [(False, 0, 1, 0)]
    assert sorted(found["middle"]) == [(True, 0, 3, 10), (True, 1, 3, 10), (True, 2, 3, 5)]


def test_rows_without_chunk_columns_are_whole_files(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"{i}.txt", "s", "text", 3, ".txt", bytearray(b"abc"), True, None, None) for i in range(5)],
        "path string, source string, file_type string, file_size bigint, extension string, content binary, "
        "content_available boolean, chunk_index int, total_chunks int")
    archive_write(rows, str(tmp_path / "a"))
    back = archive.read_archive(spark, str(tmp_path / "a"))
    assert {(r.path, r.chunk_index, r.total_chunks) for r in back.collect()} == {(f"{i}.txt", 0, 1) for i in range(5)}
    assert file_export(rows, str(tmp_path / "e"), str(tmp_path / "r")).count() == 5
    cut = rows.withColumns({"chunk_index": F.when(F.col("path") == "0.txt", 1), "total_chunks": F.when(F.col("path") == "0.txt", 2)})
    with pytest.raises(Exception, match="0.txt"):
        file_export(cut, str(tmp_path / "f"), str(tmp_path / "q"))
