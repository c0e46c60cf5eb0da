"""What the physical plans must look like on a written archive."""

import re

import pytest
from pyspark.sql import functions as F

from paperloom import bindings as B
from paperloom.operators import archive as A
from paperloom.operators import filters, manifest, rewrite, sampling, validation
from paperloom.sources import archive
from paperloom.sources.shards import archive_write, marked, row_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("plans") / "archive")
    plan = archive_write(B.archive(spark, SF), out, B.SHARD)
    return archive.read_archive(spark, out), plan, out


def explained(df):
    execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return execution.explainString(mode)


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_exclusion_reaches_the_scan(written):
    text = explained(filters.exclude_patterns(written[0], ["x", "y"]).select("path"))
    assert "Not(StringContains(path,x))" in text and read_columns(text) == [{"path"}]


def test_one_subset_is_pruned(spark, written):
    text = explained(archive.subset_scan(spark, written[2], "src3").groupBy("extension").count())
    assert re.search(r"PartitionFilters: .*source#\d+ = src3", text) and read_columns(text) == [{"extension"}]


@pytest.mark.parametrize(
    "summary",
    [A.count_by_source, A.archive_rollup, A.modality_counts, validation.availability_ratio, validation.unwanted_files,
     lambda df: sampling.bounded_sample(df.drop("content")), lambda df: sampling.top_values(df, "extension")],
)
def test_summaries_never_read_content(written, summary):
    assert all("content" not in columns for columns in read_columns(explained(summary(written[0]))))


def test_removal_counts_read_paths_only(spark, written):
    assert all("content" not in columns for columns in read_columns(explained(rewrite.removed_rows(spark, written[2]))))


def test_sizes_come_from_metadata(written):
    whole, chunks = explained(row_bytes(written[0])).split("(5) Scan", 1)
    assert "EqualTo(total_chunks,1)" in whole and all("content" not in c for c in read_columns(whole))
    assert "GreaterThan(total_chunks,1)" in chunks


def test_content_is_shuffled_once(written):
    rows, plan, _ = written
    text = explained(marked(rows, plan))
    carrying = [part for part in re.split(r"\n\n+", text)
                if re.match(r"\(\d+\) Exchange", part) and re.search(r"\bcontent#", part)]
    assert len(carrying) == 1


def test_located_rows_shuffle_no_content(spark, written, tmp_path):
    (tmp_path / "f").write_bytes(b"x")
    from paperloom.sources.listing import list_files

    rows = archive.plan_rows(list_files(spark, {"s": str(tmp_path)}))
    assert "content" not in rows.columns and {"root", "offset", "nbytes"} <= set(rows.columns)


def test_chunks_are_not_brought_together(written):
    text = explained(validation.chunk_completeness(written[0]))
    shuffled = [p for p in re.split(r"\n\n+", text) if re.match(r"\(\d+\) Exchange", p)]
    assert shuffled and not any(re.search(r"\bcontent#", p) for p in shuffled)


@pytest.mark.parametrize("operator", [manifest.dedupe_manifest, manifest.dedupe_stats, manifest.conflict_paths,
                                      manifest.conflict_md5s, manifest.skipped_duplicates])
def test_manifest_operators_combine_before_they_shuffle(spark, operator):
    text = explained(operator(B.manifest(spark, SF)))
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
    assert "partial_" in text


def test_verify_left_side_can_be_split(spark):
    """Repeated paths are on the left of a sort-merge or broadcast join, not in a window."""
    text = explained(manifest.verify_manifest(B.files_manifest(spark, SF), B.on_disk(spark, SF)))
    assert "LeftOuter" in text and "Window" not in text
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_functions_stay_in_the_jvm(spark):
    df = B.files(spark, SF).select("extension", "file_type", F.md5("text"))
    assert "Python" not in explained(df)
