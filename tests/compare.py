"""Run registered queries next to their SQL in DuckDB and compare all rows."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark: SparkSession, con, name: str, sf_dir: str) -> list[str]:
    """Empty when the query and its SQL agree."""
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return ["the plan has a cross join"]
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return []
    relation = con.sql(sql)
    want = _rows(relation.columns, relation.fetchall())
    found = []
    if sorted(df.columns) != sorted(relation.columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(relation.columns)}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        odd = [(g, w) for g, w in zip(got, want) if g != w][:3]
        found.append(f"values differ: {odd}")
    mine = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    found += [f"type of {c}: {mine[c]} != {theirs.get(c)}" for c in mine if mine[c] != theirs.get(c)]
    return found


if __name__ == "__main__":
    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            found = differences(session, duck, name, folder)
        except Exception as exc:  # noqa: BLE001
            found = [f"{type(exc).__name__}: {exc}"[:1500]]
            traceback.print_exc(limit=3)
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.2f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
