"""Operators run where workers cannot import the package, and keep clashing columns."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from paperloom.llm import decontaminate
from paperloom.llm.staging import unused

ROOT = Path(__file__).resolve().parents[2]
PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
for name in {names}:
    print("ROWS", name, len(entry.queries()[name](spark, {tables!r}).collect()))
"""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(60).coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return str(out)


def test_workers_need_no_copy_of_the_package(tables, tmp_path):
    names = [f"op{n}_" for n in (1, 2, 3, 5, 6, 9, 12, 13)]
    from paperloom.llm.queries import QUERIES
    names = [q for q in QUERIES if any(q.startswith(n) for n in names)]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", PROGRAM.format(root=str(ROOT), names=names, tables=tables)], cwd=tmp_path, env=env,
                          capture_output=True, text=True)
    assert said.returncode == 0, said.stderr[-2000:]
    assert [x.split()[1] for x in said.stdout.splitlines() if x.startswith("ROWS")] == names


def test_columns_called_like_ours_come_back(spark):
    schema = "doc_id long, text string, _id long, _HASH string"
    docs = spark.createDataFrame([(1, "one two three " * 5, 7, "a"), (2, "four five", 8, "b")], schema)
    benchmark = spark.createDataFrame([(1, "one two three " * 5)], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.keep_clean(docs, benchmark).collect()] == [(2, "four five", 8, "b")]
    assert unused(docs, "_id", "_hash", "x", "x") == ["_id_", "_hash_", "x", "x_"]
