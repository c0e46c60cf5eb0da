"""Full paths of a folder listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as C
from paperloom.plans.staging import stage


def tree_paths(
    listing: DataFrame, root_id: str | None = None, recursive: bool = True, on_cycle: str = "skip"
) -> DataFrame:
    """Files of a listing with their full paths: (id, path, mime_type, md5, size).

    Starts below `root_id`, or at the entries without a parent. Trashed entries are
    skipped with everything below them; an entry without a name goes by its id. With
    `recursive=False` only files directly at the start are kept.

    Only folders are joined with each other, by pointer jumping: a folder knows the names
    up to an ancestor, and takes over those of the ancestor, so it reaches twice as far with
    every round. Rounds are as many as the logarithm of the depth; each is a checkpoint, so
    nothing is computed twice. Files, the bulk of a listing, are joined once at the end.
    A folder whose parent is not listed is left out with all below it, and so are folders
    that contain each other, or with `on_cycle="fail"` these fail the job by name.
    """
    if on_cycle not in ("skip", "fail"):
        raise ValueError(f"on_cycle must be 'skip' or 'fail', not {on_cycle!r}")
    named = (
        listing.where(~F.coalesce("trashed", F.lit(False)))
        .withColumn("name", F.coalesce(F.nullif("name", F.lit("")), "id"))
    )
    is_folder = F.coalesce(F.col("mime_type") == C.FOLDER_MIME, F.lit(False))
    file_columns = ["id", "path", "mime_type", "md5", "size"]
    at_start = F.col("parent_id").isNull() if root_id is None else F.col("parent_id") == root_id
    start_files = named.where(~is_folder & at_start).withColumn("path", F.col("name"))
    if not recursive:
        return start_files.select(file_columns)

    folders = named.where(is_folder).select("id", "parent_id", "name")
    if root_id is not None:
        folders = folders.where(F.col("id") != root_id)
    placed = _folder_paths(stage(folders), at_start, on_cycle)
    if placed is None:
        return start_files.select(file_columns)
    nested = (
        named.where(~is_folder)
        .join(placed.select(F.col("id").alias("parent_id"), "folder"), "parent_id")
        .withColumn("path", F.concat_ws("/", "folder", "name"))
    )
    return start_files.select(file_columns).unionAll(nested.select(file_columns))


def _folder_paths(folders: DataFrame, at_start: Column, on_cycle: str) -> DataFrame | None:
    """(id, folder) of every folder below the start; null if there is none.

    `up` is the ancestor whose child the path begins with, null for a path that begins at
    the start.
    """
    open_ = folders.select("id", F.when(~F.coalesce(at_start, F.lit(False)), F.col("parent_id")).alias("up"),
                           F.coalesce(at_start, F.lit(False)).alias("begins"), F.col("name").alias("folder"))
    nodes = stage(open_.where("begins or up is not null").drop("begins"))
    count = nodes.count()
    if not count:
        return None
    for _ in range(count.bit_length() + 1):
        waiting = nodes.where("up is not null")
        if waiting.isEmpty():
            return nodes.select("id", "folder")
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("folder").alias("before"))
        jumped = waiting.join(above, "up").select("id", F.col("next").alias("up"), F.concat_ws("/", "before", "folder").alias("folder"))
        nodes = stage(nodes.where("up is null").unionAll(jumped))
    if on_cycle == "fail" and (odd := nodes.where("up is not null").orderBy("id").first()):
        raise ValueError(f"folders contain each other: {odd.id} lies below itself or below such a folder")
    return nodes.where("up is null").select("id", "folder")
