"""Merkle manifests of tables, with a proof for every row.

Rows are leaves; FANOUT consecutive nodes of a group make one of the level above, up to a
root per group, and group roots make a tree of their own. Proofs come from pointer jumping:
a node holds the siblings it meets on the way to an ancestor; joined with that ancestor it
takes over the ancestor's segment and reaches twice as far, until every leaf is at the root.
Rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import staged
from paperloom.plans.ordering import row_positions

FANOUT = 3
#: Levels built in one go, from blocks of FANOUT ** LEVELS consecutive nodes.
LEVELS = 6
BLOCK = FANOUT**LEVELS
#: Segment of a proof: per level a byte for the own place among the children, then the
#: digests of the others from left to right.
SEGMENT = "array<binary>"


def digest_of(*columns: Column) -> Column:
    """SHA-256 (lowercase hex) of values that each come with their length: `-` for null,
    else the number of UTF-8 bytes, a colon and the value."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(field, columns)), 256)


def _parents(hashes: Column) -> Column:
    """Digests of every FANOUT consecutive hashes; the last ones may be fewer."""
    last = F.floor((F.size(hashes) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(
        F.array_join(F.slice(hashes, i * FANOUT + 1, F.lit(FANOUT)), ""), 256))


def _levels() -> Column:
    """The levels over the block `hashes`, as arrays: LEVELS of them, or up to the root if
    the block is all that is left of its tree (`width` nodes)."""
    def step(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when((F.col("width") > BLOCK) | (F.size(top) > 1), F.concat(levels, F.array(_parents(top)))).otherwise(levels)
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array("hashes"), step)


def _nodes(base: int) -> Column:
    """Every node with a parent in its block: level, place in the level, the segment to the
    parent, and the root if the parent is that. A tree of one leaf has that with no segment."""
    count = F.size("levels")
    whole = F.col("width") <= BLOCK

    def of_level(hashes: Column, k: Column) -> Column:
        def of_node(_: Column, i: Column) -> Column:
            place = i % FANOUT
            others = [F.when(place != j, F.coalesce(F.get(hashes, i - place + j), F.lit(""))).otherwise("") for j in range(FANOUT)]
            segment = F.when(count > 1, F.array(F.unhex(F.concat(F.lit("0"), place.cast("string"), *others))))
            root = F.when(whole & (k >= count - 2), F.unhex(F.get(F.element_at("levels", -1), F.lit(0))))
            first = F.col("block") * F.element_at(F.array(*[F.lit(FANOUT**(LEVELS - j)) for j in range(LEVELS + 1)]), k + 1)
            return F.struct((k + base).alias("level"), (first + i).alias("at"),
                            F.coalesce(segment, F.array().cast(SEGMENT)).alias("segment"), root.alias("root"))
        return F.when((k < count - 1) | (count == 1), F.transform(hashes, of_node)).otherwise(F.array().cast(
            "array<struct<level:int,at:bigint,segment:array<binary>,root:binary>>"))
    return F.flatten(F.transform("levels", of_level))


def _build(leaves: DataFrame, sizes: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Nodes and roots of the trees over leaves (tree, at, hash): (tree, n, level, at,
    segment, root), and (tree, n, hash). `sizes` has the number n of leaves of every tree.

    A block is BLOCK rows at most, and a pass over the blocks rises LEVELS levels.
    """
    level, base, nodes, roots = leaves, 0, [], []
    while True:
        hashes = F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"])
        blocks = level.groupBy("tree", F.expr(f"at div {BLOCK}").alias("block")).agg(hashes.alias("hashes")).join(sizes, "tree")
        blocks = blocks.withColumn("width", F.ceil(F.col("n") / FANOUT**base))
        built = staged(blocks.select("tree", "n", "width", "block", _levels().alias("levels")), "merkle-levels")
        nodes.append(built.select("tree", "n", F.inline(_nodes(base))))
        top = F.get(F.element_at("levels", -1), F.lit(0)).alias("hash")
        roots.append(built.where(F.col("width") <= BLOCK).select("tree", "n", top))
        if -(-largest // FANOUT**base) <= BLOCK:
            break
        level, base = built.where(F.col("width") > BLOCK).select("tree", F.col("block").alias("at"), top), base + LEVELS
    for more in nodes[1:]:
        nodes[0] = nodes[0].unionByName(more)
    for more in roots[1:]:
        roots[0] = roots[0].unionByName(more)
    return nodes[0], roots[0]


def _jumped(nodes: DataFrame, step: int) -> DataFrame:
    """Nodes whose level is a multiple of 2 * step, with the segments of their ancestors
    `step` levels up appended to their own.

    An ancestor has FANOUT ** step descendants there. Beyond BLOCK of them it comes once for
    every BLOCK descendants, so no join key has more rows than that.
    """
    narrow = min(step, LEVELS)
    below = F.col("level") % (2 * step)
    left = nodes.where(below == 0).withColumn("part", F.expr(f"at div {FANOUT**narrow}"))
    spread = FANOUT ** (step - narrow)
    level = F.col("level") - step
    last = F.floor((F.ceil(F.col("n") / F.pow(F.lit(float(FANOUT)), level)) - 1) / FANOUT**narrow).cast("long")
    right = nodes.where(below == step).select(
        "tree", level.alias("level"), F.col("segment").alias("more"), F.col("root").alias("its_root"),
        F.explode(F.sequence(F.col("at") * spread, F.least((F.col("at") + 1) * spread - 1, last))).alias("part"))
    joined = left.join(right, ["tree", "level", "part"], "left")
    none = F.array().cast(SEGMENT)
    return joined.select("tree", "n", "level", "at", F.concat("segment", F.coalesce("more", none)).alias("segment"),
                         F.coalesce("root", "its_root").alias("root"))


def _paths(nodes: DataFrame, largest: int) -> DataFrame:
    """(tree, at, segment, root) of every leaf, with the segment up to the root."""
    step, depth = 1, 0
    while FANOUT**depth < largest:
        depth += 1
    while step < depth:
        nodes = _jumped(staged(nodes, "merkle-paths"), step)
        step *= 2
    return nodes.where("level = 0").select("tree", "at", "segment", "root")


def prove(leaves: DataFrame, group_col: str = "source", order_col: str = "doc_id", leaf_col: str = "leaf") -> DataFrame:
    """`leaves` with subroot, root and proof: the root of each row's group, that of all groups,
    and the siblings on the way there, as `folded` takes them.

    Within a group rows ascend by `order_col` (null first), then by leaf; groups ascend by
    name, null first, bytewise. Rows that are equal in both are leaves of their own with
    proofs of their own. A group of one row has that leaf as its root, one group its root as
    the root of all. An empty table gives no rows. Other columns come along; subroot, root
    and proof replace columns of those names, and names beginning with `_m_` are reserved.

    Nothing is gathered by group: positions come from range partitions, levels from blocks
    of BLOCK nodes, and a join key has BLOCK rows at most. One number and the root reach the driver.
    """
    named = leaves.drop("subroot", "root", "proof")
    columns = named.columns
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    rows = staged(named.withColumns({"_m_tree": tree, "_m_row": F.monotonically_increasing_id()}), "merkle-leaves")
    rows = staged(row_positions(rows, ["_m_tree"], [order_col, leaf_col, "_m_row"], "_m_at"), "merkle-positions")
    sizes = staged(rows.groupBy(F.col("_m_tree").alias("tree")).agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    groups, largest = sizes.agg(F.count(F.lit(1)), F.max("n")).first()
    if not groups:
        return named.withColumns({"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"), "proof": F.lit(None).cast(SEGMENT)})
    own, subroots = _build(rows.select(F.col("_m_tree").alias("tree"), F.col("_m_at").alias("at"), F.col(leaf_col).alias("hash")), sizes, largest)
    tops = row_positions(subroots.select("tree", "hash").withColumn("all", F.lit("")), ["all"], ["tree"], "at")
    tops = staged(tops.select(F.col("tree").alias("name"), F.col("all").alias("tree"), "at", "hash"), "merkle-groups")
    above, top = _build(tops.select("tree", "at", "hash"), tops.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), groups)
    above = tops.join(_paths(above, groups).withColumnRenamed("segment", "more").drop("root", "tree"), "at")
    heads = own.where("root is not null").join(above.select(F.col("name").alias("tree"), "more"), "tree").withColumn(
        "segment", F.concat("segment", "more")).drop("more")
    paths = _paths(own.where("root is null").unionByName(heads), largest)
    paths = paths.select(F.col("tree").alias("_m_tree"), F.col("at").alias("_m_at"), F.col("segment").alias("proof"), F.lower(F.hex("root")).alias("subroot"))
    joined = rows.join(paths, ["_m_tree", "_m_at"])
    return joined.select(*columns, "subroot", F.lit(top.first()["hash"]).alias("root"), "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def step(digest: Column, segment: Column) -> Column:
        place, others = F.substr(segment, F.lit(2), F.lit(1)).cast("int"), F.substr(segment, F.lit(3))
        return F.sha2(F.concat(F.substr(others, F.lit(1), 64 * place), digest, F.substr(others, 64 * place + 1)), 256)
    return F.aggregate(F.transform(proof, lambda s: F.lower(F.hex(s))), leaf, step)


def siblings_digest(proof: Column) -> Column:
    """SHA-256 of all digests of a proof, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substr(F.lower(F.hex(s)), F.lit(3))), ""), 256)
