"""Intermediate tables of the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

from paperloom.plans.staging import scratch_path
from paperloom.sources.storage import resolve

#: Whether the shuffle files of a query go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as a compressed Parquet table in the shared folder and read it back.

    Later jobs read the table instead of running the plan again, and a lost executor
    costs nothing upstream. The folder belongs to the job: it lies in
    spark.checkpoint.dir and can go when the job has ended.
    """
    return staged_at(df, scratch_path(df.sparkSession, label))


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """The same in a new folder of the given name, which `dropped` takes away again."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*paths: str) -> None:
    """Delete folders of staged tables that nothing reads any more. Those in a store that
    only Spark knows, or that cannot be deleted, stay until the job has ended."""
    for path in paths:
        with suppress(OSError, ValueError, NotImplementedError):
            fs, at = resolve(path)
            fs.delete_dir(at)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end within leave no shuffle files: their results are staged or small, and
    no DataFrame is run twice. The setting of the session is then what it was before."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with so many underscores behind it that `df` has no such column."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
