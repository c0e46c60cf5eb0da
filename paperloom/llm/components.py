"""Connected components of a graph given as links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import staged


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of each batch by (node, smallest node of its tree), by union-find."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in parent]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Union-find shrinks the links within each batch first. Then every node takes the least
    root of its neighbours and the root of its root, until nothing changes: rounds grow
    with the logarithm of the longest path. No node's neighbours are gathered in one place
    other than by a combining minimum.
    """
    links = staged(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
                   .mapInArrow(_forest, "a long, b long"), "links")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                   .select("node", F.least("node", "b").alias("root")), "roots")
    while True:
        near = (both.join(roots.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        moved = staged(roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "roots")
        jump = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = staged(moved.join(jump, "root").select("node", "old", F.col("next").alias("root")), "roots")
        roots = moved.select("node", "root")
        if moved.where("old <> root").isEmpty():
            return roots
