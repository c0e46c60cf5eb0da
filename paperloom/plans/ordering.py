"""Running totals over a global order without a task per group.

A plain window `partitionBy(source).orderBy(path)` sends a whole source to one
task. Here the rows are range partitioned on (group, order), so a source holding
a third of the table is spread over many parts; only one total per (group, part)
is combined in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.plans.staging import stage

PART = "_part"


def running_total(
    df: DataFrame, group: list[str], order: list[str], value: Column, name: str
) -> DataFrame:
    """Add `name`: the sum of `value` over all earlier rows of the same group.

    `order` must be unique within the group. A null in a group column fails the job.
    """
    keys = [*group, PART]
    parts = stage(
        df.withColumn("_value", value)
        .withColumns({g: _not_null(g) for g in group})
        .repartitionByRange(*group, *order)
        .withColumn(PART, F.spark_partition_id())
    )
    earlier_rows = (Window.unboundedPreceding, -1)
    over_parts = Window.partitionBy(*group).orderBy(PART).rowsBetween(*earlier_rows)
    offsets = (
        parts.groupBy(*keys)
        .agg(F.sum("_value").alias("_total"))
        .select(*keys, F.coalesce(F.sum("_total").over(over_parts), F.lit(0)).alias("_offset"))
    )
    in_part = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier_rows)
    return (
        parts.join(offsets, keys)
        .withColumn(
            name, F.col("_offset") + F.coalesce(F.sum("_value").over(in_part), F.lit(0))
        )
        .drop("_value", "_offset", PART)
    )


def _not_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} must not be null")))


def row_positions(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add `name`: the 0-based position of each row within its group."""
    return running_total(df, group, order, F.lit(1).cast("bigint"), name)
