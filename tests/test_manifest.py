"""Manifest operators against plain loops, and the JSON forms."""

import json
import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import manifest as M
from paperloom.schema import MANIFEST
from paperloom.sources import manifest as S


def make(n=400, seed=3):
    rng = random.Random(seed)
    return [
        (i, f"id{i}", rng.choice(["p", "p", "p", "q", "r", None, f"u{rng.randint(0, 20)}"]),
         rng.choice(["m1", "m1", "m2", "", None, f"x{rng.randint(0, 9)}"]), rng.choice([0, 5, None]))
        for i in range(n)
    ]


def first_wins(entries):
    seen, kept, by_path = set(), [], {}
    for e in entries:
        if e[3] is None:
            kept.append(e)
            continue
        if (e[2], e[3]) in seen:
            continue
        seen.add((e[2], e[3]))
        kept.append(e)
        if e[2] is not None:
            by_path.setdefault(e[2], set()).add(e[3])
    return kept, {p: m for p, m in by_path.items() if len(m) > 1}


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_and_stats(spark, seed):
    entries = make(seed=seed)
    df = spark.createDataFrame(entries, MANIFEST).repartition(5)
    kept, conflicts = first_wins(entries)
    got = sorted(tuple(r) for r in M.dedupe_manifest(df).collect())
    assert got == kept
    stats = M.dedupe_stats(df).first().asDict()
    assert stats == {
        "entries_before": len(entries), "entries_after": len(kept),
        "duplicates_removed": len(entries) - len(kept),
        "md5_missing_entries": sum(e[3] is None for e in entries), "conflicting_paths": len(conflicts),
    }
    assert {r.path: r.md5_count for r in M.conflict_paths(df).collect()} == {p: len(m) for p, m in conflicts.items()}
    pairs = {(r.path, r.md5) for r in M.conflict_md5s(df).collect()}
    assert pairs == {(p, m) for p, ms in conflicts.items() for m in ms}
    sample = M.conflict_sample(df, 3)
    order = [p for p in dict.fromkeys(e[2] for e in entries if e[3] is not None) if p in conflicts][:3]
    listed = [r.path for r in sample.select("path", "path_ord").distinct().orderBy("path_ord").collect()]
    assert listed == order
    assert {(r.path, r.md5) for r in sample.collect()} == {(p, m) for p in order for m in conflicts[p]}


def test_empty_manifest(spark, tmp_path):
    empty = spark.createDataFrame([], MANIFEST)
    assert M.dedupe_stats(empty).first().asDict() == dict.fromkeys(
        ["entries_before", "entries_after", "duplicates_removed", "md5_missing_entries", "conflicting_paths"], 0)
    assert S.manifest_write(empty, str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()


def test_a_dominating_pair_is_combined_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.col("id").alias("ord"), F.lit("i").alias("id"), F.lit("p").alias("path"), F.lit("m").alias("md5"),
        F.lit(1).cast("bigint").alias("size"))
    plan = M.dedupe_manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    assert [r.ord for r in M.dedupe_manifest(df).collect()] == [0]


ON_DISK = [("ok", 5, "m"), ("short", 4, "m"), ("bad", 5, "x"), ("zero", 9, "m"), ("nomd5", 5, "z")]
WANTED = [
    (0, "a", "ok", "m", 5), (1, "b", "short", "m", 5), (2, "c", "bad", "m", 5), (3, "d", "zero", "m", 0),
    (4, "e", "nomd5", None, 5), (5, "f", "gone", "m", 5), (6, "g", "nomd5", "", None), (7, "h", "gone", "m", 5),
    (8, "i", "gone", None, None), (9, "j", "gone", None, None),
]


def test_verify(spark):
    wanted = spark.createDataFrame(WANTED, MANIFEST)
    disk = spark.createDataFrame(ON_DISK, "path string, file_size bigint, md5 string")
    status = {r.ord: r.status for r in M.verify_manifest(wanted, disk).collect()}
    assert status == {0: "ok", 1: "size_mismatch", 2: "md5_mismatch", 3: "ok", 4: "ok", 5: "missing", 6: "ok",
                      7: "missing", 8: "missing", 9: "missing"}
    unchecked = {r.ord: r.status for r in M.verify_manifest(wanted, disk, check_md5=False).collect()}
    assert unchecked[2] == "ok" and unchecked[1] == "size_mismatch"
    failed = M.failed_sample(M.verify_manifest(wanted, disk), 3).orderBy("ord").collect()
    assert [(r.ord, r.failed_total) for r in failed] == [(1, 6), (2, 6), (5, 6)]


def test_fetch_plan(spark):
    wanted = spark.createDataFrame(WANTED, MANIFEST)
    disk = spark.createDataFrame(ON_DISK, "path string, file_size bigint, md5 string")

    def planned(**options):
        return sorted(r.ord for r in M.fetch_plan(wanted, disk, **options).collect())

    # 7 repeats 5; 8 and 9 have no md5 and both stay; 3 expects zero bytes and is checked here.
    assert planned() == [1, 2, 3, 5, 8, 9]
    assert planned(verify=False) == [5, 8, 9]
    assert planned(overwrite=True) == [0, 1, 2, 3, 4, 5, 6, 8, 9]


def test_project_casts_sizes(spark):
    rows = [("a", "p", None, "12"), ("b", "q", "m", "x"), ("c", "r", "m", None)]
    df = spark.createDataFrame(rows, "id string, path string, md5 string, size string")
    assert [r.size for r in M.manifest_project(df).orderBy("id").collect()] == [12, None, None]


AWKWARD = ['br}ace', 'quo"te', "new\nline", "  }", "[x]", "é", "a,b", "{", "", None]


def entries():
    return [{"id": f"i{i}", "path": AWKWARD[i % 10], "md5": None if i % 4 else "m", "size": i if i % 3 else None}
            for i in range(3000)]


@pytest.mark.parametrize("split_bytes", [1, 7, 1000, 20_000, 1 << 30])
def test_indented_array_is_split_and_ordered(spark, tmp_path, split_bytes):
    wanted = entries() if split_bytes >= 1000 else entries()[:12]
    file = tmp_path / ".manifest.json"
    file.write_text(json.dumps(wanted, indent=2))
    rows = S.manifest_scan(spark, str(file), split_bytes=split_bytes).orderBy("ord").collect()
    assert len({r.ord for r in rows}) == len(rows)
    assert [(r.id, r.path, r.md5, r.size) for r in rows] == [tuple(e.values()) for e in wanted]


def test_other_layouts(spark, tmp_path):
    file = tmp_path / "compact.json"
    file.write_text(json.dumps(entries()[:50]))
    rows = S.manifest_scan(spark, str(file), indented=False).orderBy("ord").collect()
    assert [(r.ord, r.id, r.path) for r in rows] == [(i, e["id"], e["path"]) for i, e in enumerate(entries()[:50])]
    indented = tmp_path / "empty.json"
    indented.write_text("[]")
    assert S.manifest_scan(spark, str(indented)).count() == 0


def test_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame(make(50), MANIFEST)
    out = str(tmp_path / "lines")
    assert S.manifest_write(df, out)
    assert sorted(map(tuple, S.manifest_lines(spark, out).collect()), key=lambda r: r[0]) == make(50)


def test_report(spark, tmp_path):
    df = spark.createDataFrame(make(), MANIFEST)
    S.report_write(M.dedupe_stats(df), M.conflict_sample(df), str(tmp_path / "r"))
    stats = spark.read.json(str(tmp_path / "r" / "stats")).first()
    assert stats.entries_before == 400
    sample = spark.read.json(str(tmp_path / "r" / "conflicts_sample"))
    assert sample.select("path").distinct().count() <= 20 and {"path", "md5"} <= set(sample.columns)


@pytest.mark.parametrize("indent", [None, 2, 4, "lines"])
def test_every_layout_gives_the_same_rows(spark, tmp_path, indent):
    entries = [{"id": str(i), "path": f"a/{i} }}\u00e9", "md5": None if i else "x", "size": i} for i in range(3)]
    text = "\n".join(map(json.dumps, entries)) if indent == "lines" else json.dumps(entries, indent=indent)
    (tmp_path / "m.json").write_text(text)
    rows = S.manifest_scan(spark, str(tmp_path / "m.json")).orderBy("ord").collect()
    assert [(r.id, r.path, r.md5, r.size) for r in rows] == [tuple(e.values()) for e in entries]


def test_text_that_is_no_manifest_fails(spark, tmp_path):
    (tmp_path / "m.json").write_text('[\n  {\n    "id": "1"\n  }, {"id": "2"}]')
    with pytest.raises(Exception, match="no entry"):
        S.manifest_scan(spark, str(tmp_path / "m.json")).collect()


def test_equal_paths_of_two_sources_stay_apart(spark):
    manifest = spark.createDataFrame([(0, "1", "p", "m", 1, "a"), (1, "2", "p", "m", 1, "b")], "ord bigint, id string, path string, md5 string, size bigint, source string")
    actual = spark.createDataFrame([("a", "p", 1, "m"), ("b", "p", 2, "m"), ("c", "p", 1, "m")], "source string, path string, file_size bigint, md5 string")
    assert sorted((r.source, r.status) for r in M.verify_manifest(manifest, actual).collect()) == [("a", "ok"), ("b", "size_mismatch")]
    assert M.dedupe_manifest(manifest).count() == 2 and [r.id for r in M.fetch_plan(manifest, actual).collect()] == ["2"]
