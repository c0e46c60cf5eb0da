"""What the footers of shards say: columns as they are on disk, rows and bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from paperloom import constants as C
from paperloom.sources.commits import schema_hash, shards
from paperloom.sources.listing import list_files
from paperloom.sources.storage import resolve

FOOTER = ("source string, path string, bytes bigint, rows bigint, schema_hash string, "
          "columns array<struct<name: string, type: string>>")
#: Footers that one task opens.
PER_TASK = 500


def _type_name(kind: pa.DataType) -> str:
    """The type as Spark names it; as Arrow does where Spark has none."""
    try:
        return from_arrow_type(kind).simpleString()
    except Exception:  # noqa: BLE001  any type that Spark refuses
        return str(kind)


def _opener(root: str):
    column = pa.struct([("name", pa.string()), ("type", pa.string())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, columns = [], [], []
            for relative in batch.column("path").to_pylist():
                fs, path = resolve(f"{root}/{relative}")
                with fs.open_input_file(path) as handle:
                    file = pq.ParquetFile(handle)
                    rows.append(file.metadata.num_rows)
                    hashes.append(schema_hash(file.schema_arrow))
                    columns.append([{"name": f.name, "type": _type_name(f.type)} for f in file.schema_arrow])
            found = [pa.array(rows, pa.int64()), pa.array(hashes, pa.string()), pa.array(columns, pa.list_(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "rows", "schema_hash", "columns"])
    return read


def shard_footers(spark: SparkSession, root: str, partitioned: bool = True, large: bool = False) -> DataFrame:
    """(source, path, bytes, rows, schema_hash, columns) of every shard, read by tasks from
    the footers alone. With `large` the files of the side table come along, as a subset."""
    root = root.rstrip("/")
    listed = shards(spark, root, partitioned)
    if large:
        side = list_files(spark, {"": root}).where(F.startswith("path", F.lit(f"{C.LARGE_SUBSET}/")) & F.endswith("path", F.lit(".parquet")))
        listed = listed.where(F.col("source") != C.LARGE_SUBSET).unionAll(side.select(F.lit(C.LARGE_SUBSET), "path", "file_size"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-listed.count() // PER_TASK))
    return listed.repartition(tasks, "path").mapInArrow(_opener(root), FOOTER)


def schemas_on_disk(footers: DataFrame) -> DataFrame:
    """(subset, column, type, files): how many shards of a subset have a column of a type."""
    each = footers.select(F.col("source").alias("subset"), F.explode("columns").alias("c"))
    return each.groupBy("subset", F.col("c.name").alias("column"), F.col("c.type").alias("type")).agg(F.count("*").alias("files"))
