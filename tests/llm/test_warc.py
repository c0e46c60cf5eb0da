import gzip
import random

from pyspark.sql import functions as F

from paperloom.llm import warc
from paperloom.llm.staging import staged

SCHEMA = "page_id long, url string, html string, archive int"


def pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>é {i}\r\n\r\nWARC/1.1\r\n</p>" + "z" * (i % 7), 1) for i in range(90)]
    return spark.createDataFrame(rows + [(None, None, None, 1), (5, "http://x/5", "", 1), (5, "http://x/5", "", 1)], SCHEMA)


def plain(row):
    return row.archive, row.ordinal, bytes(row.record), row.start, row.length


def test_files_read_back_as_they_were_placed(spark, tmp_path):
    made = warc.records(pages(spark), per_archive=31)
    done = warc.write_warc(made, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert sorted(map(plain, made.collect())) == sorted(map(plain, back.collect())) and made.count() == 93
    assert warc.audit(made, back).count() == 0
    files = sorted((tmp_path / "w").glob("*.warc.gz"))
    assert [len(gzip.decompress(f.read_bytes())) for f in files] == [r.bytes for r in done.orderBy("archive").collect()] and len(files) == 3
    for r in made.collect():
        data = gzip.decompress(files[r.archive].read_bytes())
        assert data[r.start:r.start + r.length] == bytes(r.record) + b"\r\n\r\n"


def test_archives_are_of_one_size_whatever_the_ids(spark):
    ids = spark.range(300).select((F.col("id") * 40).alias("page_id"), F.lit("u").alias("url"), F.lit("b").alias("html"))
    same = spark.range(200).select(F.lit(7).cast("long").alias("page_id"), F.lit("u").alias("url"), F.lit("b").alias("html"))
    sizes = warc.records(ids.unionAll(same), per_archive=50).groupBy("archive").count().collect()
    assert sorted(r.archive for r in sizes) == list(range(10)) and {r["count"] for r in sizes} == {50}


def test_pieces_of_any_size_give_the_same_records(spark, tmp_path):
    made = warc.records(pages(spark), per_archive=1000)
    warc.write_warc(made, str(tmp_path / "w"))
    data = gzip.decompress(next((tmp_path / "w").glob("*.warc.gz")).read_bytes())
    whole = list(warc._split([data]))
    for size in (1, 3, 64, 1000):
        assert list(warc._split(data[i:i + size] for i in range(0, len(data), size))) == whole
    assert list(warc._split([])) == list(warc._split([b""])) == []
    assert list(warc._split([b"no archive"])) == [(b"no archive", 0, 10)]
    assert b"".join(data[s:s + n] for _, s, n in whole) == data


def test_damage_on_disk_is_located(spark, tmp_path):
    """Bytes that are not text, wrong and absurd lengths, lost bytes, cut and lost files."""
    plain_pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>é {i}</p>", 1) for i in range(120)], SCHEMA)
    made = warc.records(plain_pages, per_archive=30)
    ours, copies = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_warc(made, ours)
    at = {(r.archive, r.ordinal): (r.start, r.length, bytes(r.record)) for r in made.collect()}
    body = at[0, 3][0] + at[0, 3][2].index(b"\xc3")
    size = at[1, 4][0] + at[1, 4][2].index(b"Length: ") + 8
    edits = [(0, body, 1, b"\xfe"), (1, size, 2, b"99999999999999999"), (1, at[1, 9][0] + 7, 1, b""), (2, at[2, 28][0] + 20, 1 << 62, b""),
             (2, at[2, 29][0], 1, b"x")]
    warc.copy_spliced(spark, ours, copies, spark.createDataFrame([(a, b, c, bytearray(d)) for a, b, c, d in edits], "archive long, at long, drop long, put binary"))
    (tmp_path / "b" / "archive-0000000003.warc.gz").unlink()
    read, kept = warc.read_warc(spark, copies), (tmp_path / "b" / "archive-0000000000.warc.gz").read_bytes()
    found = {(r.archive, r.ordinal): r.fault for r in warc.audit(warc.read_warc(spark, ours), read).collect()}
    want = {(0, 3): "changed", (1, 4): "changed", (1, 9): "changed", (2, 28): "changed", (2, 29): "missing"}
    broken = tmp_path / "b" / "archive-0000000000.warc.gz"
    broken.write_bytes(kept[:len(kept) // 2])
    cut = {(r.archive, r.ordinal): r.fault for r in warc.audit(warc.read_warc(spark, ours), warc.read_warc(spark, copies)).where("archive = 0").collect()}
    lost = {k for k, v in cut.items() if v == "missing"}
    assert lost == {(0, i) for i in range(30 - len(lost), 30)} and 0 < len(lost) < 30 and len(cut) <= len(lost) + 2
    broken.write_bytes(b"")
    assert warc.read_warc(spark, copies).where("archive = 0").count() == 0
    broken.write_bytes(kept)
    want |= {(1, i): "moved" for i in [*range(5, 9), *range(10, 30)]} | {(3, i): "missing" for i in range(30)}
    assert found == want
    assert {(r.archive, r.ordinal): r.fault for r in warc.audit(read, made).collect()}[3, 0] == "surplus"


def test_splices_are_exact_at_the_borders_of_pieces(spark, tmp_path, monkeypatch):
    data, edits = random.Random(1).randbytes(3000), [(0, 2, b""), (1, 5, b"in"), (10, 0, b"new"), (15, 4, b""), (15, 9, b"x"), (16, 3, b"y"), (2990, 50, b"end")]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f").write_bytes(data)
    import pyarrow as pa
    kind = pa.list_(pa.struct([("at", pa.int64()), ("drop", pa.int64()), ("put", pa.binary())]))
    batch = pa.record_batch([pa.array(["f"]), pa.array([[{"at": a, "drop": d, "put": p} for a, d, p in edits]], kind)], ["path", "edits"])
    want = data[2:10] + b"new" + data[10:15] + data[19:2990] + b"end"
    packed = gzip.compress(data[:1000]) + gzip.compress(data[1000:])
    for size in (1, 7, 4096):
        monkeypatch.setattr(warc, "_BATCH_BYTES", size)
        monkeypatch.setattr(warc, "read_from", lambda uri: (packed[i:i + size] for i in range(0, len(packed), size)))
        list(warc._splicer(str(tmp_path / "a"), str(tmp_path / f"b{size}"))([batch]))
        assert gzip.decompress((tmp_path / f"b{size}" / "f").read_bytes()) == want


def test_only_differing_branches_are_read(spark):
    ours = warc.tree(warc.records(pages(spark), per_archive=1000))
    assert [level.count() for level in ours] == [93, 6, 1]
    assert warc.differences(ours, ours).count() == 0


def test_empty_table(spark):
    none = warc.records(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and warc.audit(none, none).count() == 0
    assert {r.fault for r in warc.audit(warc.records(pages(spark)), none).collect()} == {"missing"}


def test_records_move_once_to_their_file(spark, tmp_path, monkeypatch):
    """Between the staged records and the files there is one exchange with content."""
    plans = []
    monkeypatch.setattr(warc, "staged", lambda df, label: plans.append((label, df)) or staged(df, label))
    warc.write_warc(warc.records(pages(spark), per_archive=31), str(tmp_path / "w"))
    plan = dict(plans)["written"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_runs_of_archives_share_a_first_key(spark, tmp_path, monkeypatch):
    made = sorted(map(plain, warc.records(pages(spark), per_archive=10).collect()))
    monkeypatch.setattr(warc, "MAX_RANGES", 3)
    few = warc.records(pages(spark), per_archive=10)
    assert sorted(map(plain, few.collect())) == made and {m[0] for m in made} == set(range(10))
    warc.write_warc(few, str(tmp_path / "w"))
    assert sorted(map(plain, warc.read_warc(spark, str(tmp_path / "w")).collect())) == made
