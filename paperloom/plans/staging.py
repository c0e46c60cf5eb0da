"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's spark.checkpoint.dir.

    Only a local session without that setting (a test) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[[^,]*(,\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paperloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder name inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Materialise `df` as a reliable checkpoint.

    Values that depend on the physical layout (partition ids) or that several
    later jobs read are fixed here once; a lost executor costs nothing upstream.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()
