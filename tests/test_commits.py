"""What readers see of an archive while and after it is written."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from paperloom.operators.rewrite import filter_archive
from paperloom.operators.validation import schema_diff_on_disk, validate_archive
from paperloom.schema import ARCHIVE, LARGE_FILES
from paperloom.sources import archive, commits
from paperloom.sources.footers import schemas_on_disk, shard_footers
from paperloom.sources.shards import archive_write


def rows(spark, n, mark=b"x", sources=("a", "b")):
    return spark.createDataFrame(
        [(f"f{i:03d}.txt", s, "text", 10, ".txt", bytearray(mark * 10), True, 0, 1) for s in sources for i in range(n)], ARCHIVE)


def located(spark, n, root):
    listed = rows(spark, n, sources=("a",)).drop("content")
    return listed.withColumns({"root": F.lit(str(root)), "offset": F.lit(0).cast("bigint"), "nbytes": F.lit(10).cast("bigint")})


def read(spark, out, **options):
    return sorted((r.source, r.path, bytes(r.content)) for r in archive.read_archive(spark, str(out), **options).collect())


def test_a_failed_first_write_is_no_archive(spark, tmp_path):
    out = tmp_path / "out"
    (tmp_path / "in").mkdir()
    for i in range(39):  # the last file is not there
        (tmp_path / "in" / f"f{i:03d}.txt").write_bytes(b"y" * 10)
    with pytest.raises(Exception, match="f039"):
        archive_write(located(spark, 40, tmp_path / "in"), str(out), 20)
    with pytest.raises(FileNotFoundError, match="never written"):
        archive.read_archive(spark, str(out))
    with pytest.raises(FileNotFoundError):
        archive.subset_scan(spark, str(out), "a")
    assert not list(out.rglob(".paperloom-part-*"))


def test_a_failed_replacement_leaves_the_old_archive(spark, tmp_path):
    out = tmp_path / "out"
    archive_write(rows(spark, 6), str(out), 20)
    before = read(spark, out)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f000.txt").write_bytes(b"y" * 10)
    with pytest.raises(Exception, match="f00"):
        archive_write(located(spark, 9, tmp_path / "in"), str(out), 20, replace=True)
    assert read(spark, out) == before and len(before) == 12
    archive_write(rows(spark, 3, b"z"), str(out), 20, replace=True)
    after = read(spark, out)
    assert len(after) == 6 and {c for _, _, c in after} == {b"z" * 10}
    assert read(spark, out, version=1) == before
    assert {r.source: r.shards for r in archive.discover_subsets(spark, str(out)).collect()} == {"a": 2, "b": 2}
    assert commits.vacuum(str(out)) and read(spark, out) == after
    with pytest.raises(FileNotFoundError):
        read(spark, out, version=1)
    with pytest.raises(FileExistsError):
        archive_write(rows(spark, 3), str(out), 20)


@pytest.mark.parametrize("logged", [True, False])
def test_filtering_is_one_swap(spark, tmp_path, logged, monkeypatch):
    out = tmp_path / "out"
    archive_write(rows(spark, 8), str(out), 20)
    if not logged:  # an archive from elsewhere
        for file in [*(out / "_log").iterdir()]:
            file.unlink()
        (out / "_log").rmdir()
    before = read(spark, out)
    from paperloom.operators import rewrite

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(rewrite, "publish", lost) if logged else m.setattr(rewrite, "commit_folder", lost)
        with pytest.raises(OSError, match="lost"):
            filter_archive(spark, str(out), ["f003", "f005"])
    assert read(spark, out) == before
    counts = filter_archive(spark, str(out), ["f003", "f005"])
    assert {tuple(r) for r in counts.groupBy("source").agg(F.sum("rows_removed")).collect()} == {("a", 2), ("b", 2)}
    assert read(spark, out) == [r for r in before if r[1] not in ("f003.txt", "f005.txt")]
    assert read(spark, out, version=1) == before
    assert filter_archive(spark, str(out), ["f003"]).agg(F.sum("rows_removed")).first()[0] == 0
    filter_archive(spark, str(out), ["f007"])
    assert len(read(spark, out)) == 10 and commits.versions(str(out)) == [1, 2, 3]


def test_edges_see_first_and_last_shards_only(spark, tmp_path):
    archive_write(rows(spark, 8), str(tmp_path / "out"), 20)
    filter_archive(spark, str(tmp_path / "out"), ["f003", "f007"], edges_only=True)
    assert {p for _, p, _ in read(spark, tmp_path / "out")} == {f"f{i:03d}.txt" for i in range(7)}


def test_two_writers_cannot_publish_one_version(tmp_path):
    commits.publish(str(tmp_path), 1, [])
    with pytest.raises(FileExistsError):
        commits.publish(str(tmp_path), 1, [])


def test_columns_as_they_are_on_disk(spark, tmp_path):
    out = tmp_path / "out"
    archive_write(rows(spark, 8), str(out), 20)
    short, mistyped = sorted((out / "source=a").glob("*.parquet"))[:2]
    pq.write_table(pq.ParquetFile(short).read().drop_columns(["chunk_index", "total_chunks"]), short)
    table = pq.ParquetFile(mistyped).read()
    pq.write_table(table.set_column(3, "file_size", table.column("file_size").cast(pa.string())), mistyped)
    footers = shard_footers(spark, str(out))
    found = {(r.subset, r.column, r.type): r.files for r in schemas_on_disk(footers).collect()}
    assert found["a", "chunk_index", "int"] == 3 and found["b", "chunk_index", "int"] == 4
    assert found["a", "file_size", "string"] == 1 and found["a", "content", "binary"] == 4
    want = {("a", "chunk_index", "missing", 1, "error"), ("a", "total_chunks", "missing", 1, "error"), ("a", "file_size", "type", 1, "warning")}
    assert {tuple(r) for r in schema_diff_on_disk(footers, ARCHIVE).collect()} == want
    checks = validate_archive(rows(spark, 8), spark.createDataFrame([], LARGE_FILES), rows(spark, 1).select("source"),
                              expected_schema=ARCHIVE, probe_content=False, footers=footers)
    assert {(r.subset, r.detail, r.n) for r in checks.where("check = 'schema'").collect()} == {(s, f"{k} {c}", n) for s, c, k, n, _ in want}


def test_names_with_spaces_and_letters(spark, tmp_path):
    archive_write(rows(spark, 2, sources=("a b", "é+x%=y")), str(tmp_path / "out"), 20)
    assert [r.path for r in archive.subset_scan(spark, str(tmp_path / "out"), "é+x%=y").collect()] == ["f000.txt", "f001.txt"]
    filter_archive(spark, str(tmp_path / "out"), ["f001"])
    assert {(s, p) for s, p, _ in read(spark, tmp_path / "out")} == {("a b", "f000.txt"), ("é+x%=y", "f000.txt")}


def test_a_folder_of_shards_is_one_path(spark, tmp_path):
    """Spark is given folders, unless a folder holds what the log does not name."""
    out = tmp_path / "out"
    archive_write(rows(spark, 6), str(out), 20)
    before = read(spark, out)
    paths = [f"{out}/{p}" for p in commits.committed(str(out)).column("path").to_pylist()]
    assert len(paths) == 6 and sorted(archive._as_folders(paths)) == [f"{out}/source={s}" for s in "ab"]
    shard = next((out / "source=a").glob("*.parquet"))
    (out / "source=a" / "left.parquet").write_bytes(shard.read_bytes())
    assert sorted(archive._as_folders(paths)) == sorted([*[p for p in paths if "source=a" in p], f"{out}/source=b"])
    assert read(spark, out) == before


def test_rows_are_made_once_to_be_planned(spark, tmp_path):
    """Once for sizes of whole files, once for those of chunks, and once to be written."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    archive_write(rows(spark, 30).mapInArrow(count, ARCHIVE), str(tmp_path / "out"), 20)
    assert made.value == 3 * 60
