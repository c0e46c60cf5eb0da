import random

from paperloom.llm import decontaminate
from tests.llm.helpers import hits

DOCS = "doc_id long, text string, row int, hash string"
ITEMS = "item_id long, text string, words int"


def cases():
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta", "é1", "ßx", "7", "日本"]) + rng.choice("abcdefghij")
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 9, 10, 11, 25, 60])))) for i in range(40)]
    items += [(40, ""), (41, None), (42, "... --"), (3, "again " * 12), (None, "nameless item of some words that is long enough to be a window")]
    docs = []
    for i in range(150):
        w = [word() for _ in range(rng.choice([0, 3, 9, 10, 50, 300]))]
        for _ in range(rng.randrange(3)):
            part = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(part) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = part[a:a + rng.choice([5, 9, 10, 11, 40])]
        docs.append((i, rng.choice([" ", ", ", "-"]).join(w).title()))
    return docs + [(500, None), (501, ""), (502, "again " * 400), (502, "other"), (None, items[-1][1].upper())], items


def test_hits_equal_those_of_all_windows(spark):
    docs, items = cases()
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS)
    bench = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"] or ())) for r in decontaminate.contamination(rows, bench).collect()), key=key)
    want = sorted(hits(docs, items), key=key)
    assert got == want and sum(x[2] > 0 for x in want) > 20
    kept = decontaminate.keep_clean(rows, bench)
    clean = sorted((x[0], x[1]) for x in hits(docs, items) if not x[2])
    assert sorted((r.doc_id, len(r.text or "")) for r in kept.collect()) == sorted(
        (d, len(t or "")) for d, t in docs if not hits([(d, t)], items)[0][2]) and len(clean) == kept.count()
    assert kept.columns == rows.columns


def test_spans_name_the_words(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = spark.createDataFrame([(1, "x y " + item + " z", 0, ""), (2, item[:40], 0, "")], DOCS)
    got = {r.doc_id: [tuple(s) for s in r.spans or []] for r in decontaminate.contamination(rows, spark.createDataFrame([(9, item, 0)], ITEMS)).collect()}
    assert got == {1: [(2, 10), (3, 10), (4, 10)], 2: []}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", 0, "")], DOCS), spark.createDataFrame([], ITEMS)
    assert [r.n_hit for r in decontaminate.contamination(docs, items).collect()] == [0]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
