"""Folder trees."""

import random

import pytest

from paperloom import constants as C
from paperloom.plans.staging import stage
from paperloom.plans.tree import tree_paths
from paperloom.schema import LISTING


def make():
    rng = random.Random(2)
    rows = [("root", None, "top", C.FOLDER_MIME, None, None, False)]
    folders = ["root"]
    for i in range(60):
        parent = rng.choice(folders[-6:])
        name = rng.choice([f"d{i}", "", None])
        rows.append((f"F{i}", parent, name, C.FOLDER_MIME, None, None, rng.random() < 0.1))
        folders.append(f"F{i}")
    for i in range(300):
        parent = "F3" if i % 3 == 0 else rng.choice([*folders, None])
        rows.append((f"f{i}", parent, rng.choice([f"n{i}", None]), "text/plain", "m", str(i), rng.random() < 0.1))
    rows.append(("X", "Y", "cycle", C.FOLDER_MIME, None, None, False))
    rows.append(("Y", "X", "cycle", C.FOLDER_MIME, None, None, False))
    rows.append(("x", "X", "unreachable", "text/plain", None, None, False))
    rows.append(("nomime", "root", "nomime", None, None, None, None))
    return rows


def walk(rows, start, recursive=True):
    below = {}
    for r in rows:
        below.setdefault(r[1], []).append(r)
    found, stack = {}, [(start, "")]
    while stack:
        folder, prefix = stack.pop()
        for id_, _, name, mime, *_, trashed in below.get(folder, []):
            path = prefix + (name or id_)
            if trashed:
                continue
            if mime == C.FOLDER_MIME:
                if recursive:
                    stack.append((id_, path + "/"))
            else:
                found[id_] = path
    return found


@pytest.mark.parametrize("start,recursive", [(None, True), (None, False), ("root", True), ("root", False), ("F3", True), ("none", True)])
def test_tree_paths(spark, start, recursive):
    rows = make()
    df = spark.createDataFrame(rows, LISTING)
    got = tree_paths(df, start, recursive).collect()
    assert {r.id: r.path for r in got} == walk(rows, start, recursive)
    assert len({r.id for r in got}) == len(got)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from paperloom.plans import tree

    rounds = []
    monkeypatch.setattr(tree, "stage", lambda df: (rounds.append(1), stage(df))[1])
    rows = [(f"F{i}", f"F{i - 1}" if i else None, f"d{i}", C.FOLDER_MIME, None, None, False) for i in range(1000)]
    rows.append(("x", "F999", "file", "text/plain", None, None, False))
    got = tree_paths(spark.createDataFrame(rows, LISTING)).collect()
    assert [(r.id, r.path) for r in got] == [("x", "/".join(f"d{i}" for i in range(1000)) + "/file")]
    assert len(rounds) <= 14  # two to begin with, and the rounds


def test_folders_that_contain_each_other_are_named(spark):
    rows = spark.createDataFrame(make(), LISTING)
    with pytest.raises(ValueError, match="X lies below itself"):
        tree_paths(rows, on_cycle="fail")
    with pytest.raises(ValueError, match="on_cycle"):
        tree_paths(rows, on_cycle="x")
