import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.llm import rules
from tests.llm.helpers import SPACED

SCHEMA = "doc_id long, text string, lang string, source string, rules int, n long"


def plain(text):
    text = text or ""
    w = SPACED.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


TEXTS = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a a a", "x\nx\n\ny\n x\nx", "é#ß | z\x1c", "a b c d b c d b c " * 40,
         " ".join(f"w{i}" for i in range(5000)) * 2]


def test_counts_equal_a_plain_version(spark):
    rows = spark.createDataFrame([(i, t, None, None, 1, 2) for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in rules.measure(rows).select("doc_id", "rules.*").collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def good(i):
    return " ".join(f"word{(i * 37 + k * k) % 9973}" for k in range(120))


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, good(i), "en", "web" if i % 3 else None, 0, 0) for i in range(400)]
    rows += [(1000, " ".join(f"{w}$$$$$" for w in good(1).split()), "en", "web", 0, 0), (1000, good(5), "en", "web", 0, 0),
             (None, good(6), None, None, 0, 0), (1001, None, "en", "web", 0, 0), (1002, "# " * 200, "xx", "rare", 0, 0), (1002, "# " * 200, "xx", "rare", 0, 0)]
    return rules.judge(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "text", "n", "rules.*").collect()


def test_rows_keep_their_number_and_clashing_columns(judged):
    assert len(judged) == 406 and all(r.n == 0 for r in judged)


def test_outliers_go_and_good_documents_stay(judged):
    assert all(r.kept for r in judged if r.doc_id is None or r.doc_id < 1000)
    assert sorted(r.kept for r in judged if r.doc_id == 1000) == [False, True]
    assert not any(r.kept for r in judged if r.doc_id in (1001, 1002))


def test_empty_table(spark):
    assert rules.keep_good(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_of_sources_adds_up_and_quartiles_are_close(spark):
    rows = spark.createDataFrame([(i, " ".join(chr(0x4E00 + k) + "x" * ((i * k) % 17) for k in range(1, 80)), "en", f"s{i % 4}", 0, 0) for i in range(200)], SCHEMA)
    measured = rules.measure(rows)
    one, many = (rules._fences(rules.sketch(measured.withColumn("all", F.lit(1)), keys), ["all"]).first()
                 for keys in (["all"], ["all", "source"]))
    assert one == many
    exact = sorted(r[0] for r in measured.where("not rules.base_failed").select("rules.word_length").collect())
    q1, q3 = exact[(len(exact) + 3) // 4 - 1], exact[(3 * len(exact) + 3) // 4 - 1]
    low, high = one.fences["word_length"]
    width = 3 * max(q3 - q1, 16)
    assert abs(low - (q1 - width)) <= 0.25 * width + 0.04 * q1 and abs(high - (q3 + width)) <= 0.25 * width + 0.04 * q3


def test_every_measure_has_fences_of_its_source(spark):
    """Two sources that differ in all four measures, 3 % of whose documents are odd in one."""
    def text(source, i):
        w = [f"{'w' * (3 if source == 'a' else 9)}{(i * 37 + k * k) % 9973}" for k in range(300)]
        for k in range(0, (i % 5) * (1 if source == "a" else 3)):
            w[k * 7] += "##"
        repeated = w[:6 + (i % 4) * (1 if source == "a" else 4)]
        lines = [" ".join(w[k:k + 10]) for k in range(0, 300, 10)] + [" ".join(repeated)] * (2 if i % 3 else 1 if source == "a" else 5)
        return "\n".join(lines)

    rows = [(i, text(s, i) if i % 33 else f"{'#' * 2500} {text(s, i)}", "en", s, 0, 0) for s in "ab" for i in range(300)]
    measured = rules.measure(spark.createDataFrame(rows, SCHEMA).drop("rules"))
    fences = {r._t_source: r._fences for r in rules.thresholds(measured).collect()}
    for m in rules.MEASURES:
        assert tuple(fences["a"][m]) != tuple(fences["b"][m]), m
    odd = {r.doc_id for r in rules.judge(measured.drop("rules")).where("not rules.kept").collect()}
    assert odd == {i for i in range(300) if i % 33 == 0}


def test_keep_good_leaves_columns_of_its_names_alone(spark):
    rows = spark.createDataFrame([(i, good(i), "en", "web", i, 0) for i in range(30)], SCHEMA).withColumnRenamed("rules", "_rules")
    assert sorted(r._rules for r in rules.keep_good(rows).collect()) == list(range(30))
