import hashlib

import pytest
from pyspark.sql import functions as F

from paperloom.llm import merkle

SCHEMA = "doc_id long, source string, leaf string, proof int, n long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(groups):
    """(root, {name: (subroot, [proof digests of every leaf])}) level by level."""
    def tree(leaves):
        level, own = list(leaves), [(i, []) for i in range(len(leaves))]
        while len(level) > 1:
            for at, path in own:
                k = at // 3 ** len(path)
                run = range(k // 3 * 3, min(k // 3 * 3 + 3, len(level)))
                path.append([level[i] for i in run if i != k])
            level = [h("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        return level[0], [p for _, p in own]
    done = {g: tree(x) for g, x in groups.items()}
    names = sorted(done, key=lambda g: (g is not None, (g or "").encode()))
    root, above = tree([done[g][0] for g in names])
    return root, {g: (done[g][0], [h("".join(x for s in p + above[names.index(g)] for x in s)) for p in done[g][1]]) for g in names}


def proven(spark, rows):
    df = merkle.prove(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == ["doc_id", "source", "leaf", "n", "subroot", "root", "proof"]
    return df.select("*", merkle.folded(F.col("leaf"), F.col("proof")).alias("folded"), merkle.siblings_digest(F.col("proof")).alias("digest"),
                     merkle.folded(F.lit(h("x")), F.col("proof")).alias("other")).collect()


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, None: 1}, {"a": 2, "é": 4, "Z": 27, None: 28, "": 10}, {"big": 7000, "b": 729, "c": 730},
                                   {f"s{i}": i % 5 + 1 for i in range(40)}])
def test_roots_and_proofs_equal_a_plain_version(spark, sizes):
    rows = [(i, g, h(f"{g}{i}"), 0, 7) for g, n in sizes.items() for i in range(n)]
    got = proven(spark, rows[::-1])
    root, want = plain({g: [h(f"{g}{i}") for i in range(n)] for g, n in sizes.items()})
    assert len(got) == len(rows)
    for r in got:
        subroot, digests = want[r.source]
        assert (r.root, r.folded, r.subroot, r.digest, r.n) == (root, root, subroot, digests[r.doc_id], 7)
        assert r.other != root


def test_nulls_and_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(None, None, h("a"), 0, 0)] * 3 + [(1, None, h("b"), 0, 0)] * 2 + [(1, "s", h("b"), 0, 0), (1, "s", h("c"), 0, 0)]
    got = proven(spark, rows)
    root, want = plain({None: [h("a")] * 3 + [h("b")] * 2, "s": sorted([h("b"), h("c")])})
    assert len(got) == 7 and {r.folded for r in got} == {root}
    assert sorted(r.digest for r in got) == sorted(d for _, digests in want.values() for d in digests)


def test_empty_table(spark):
    assert merkle.prove(spark.createDataFrame([], SCHEMA)).collect() == []


def test_digest_tells_fields_apart(spark):
    rows = spark.createDataFrame([(1, "é", None), (1, None, "é"), (11, "", None)], "a int, b string, c string")
    got = [r[0] for r in rows.select(merkle.digest_of(*map(F.col, "abc"))).collect()]
    assert got == [h("1:12:é-"), h("1:1-2:é"), h("2:110:-")]


def test_one_changed_byte_is_found(spark):
    rows = [(i, "s", h(str(i)), 0, 0) for i in range(100)]
    df = merkle.prove(spark.createDataFrame(rows, SCHEMA)).withColumn("found", F.expr("if(doc_id = 41, sha2('41 ', 256), leaf)"))
    bad = df.where(merkle.folded(F.col("found"), F.col("proof")) != F.col("root")).collect()
    assert [r.doc_id for r in bad] == [41]
