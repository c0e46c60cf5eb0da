import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import classifier
from paperloom.llm.words import SPACED, words

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    vectors, net = classifier.fit(docs, labels.where(~held))
    rows = classifier.score(docs, vectors, net).join(labels.where(held), "doc_id").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows)
    low = [r.score for r in rows if r.quality == 0]
    high = [r.score for r in rows if r.quality == 1]
    above = sum(h > x for x in low for h in high) / (len(low) * len(high))
    assert right > 0.85 and above > 0.9 and all(0 <= r.score <= 1 for r in rows)
    again = classifier.fit(docs.repartition(3), labels.where(~held).repartition(2))[0]
    assert (again == vectors).all()


def test_odd_rows(spark):
    schema = "doc_id long, text string, score int, label string"
    docs = spark.createDataFrame([(1, None, 0, ""), (1, "", 0, ""), (None, "a b", 0, ""), (2, "word " * 50_000, 0, "")], schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    vectors, net = classifier.fit(docs, labels)
    assert sorted(r.doc_id or 0 for r in classifier.score(docs, vectors, net).collect()) == [0, 1, 1, 2]
    vectors, net = classifier.fit(docs, labels.limit(0))
    assert [r.score for r in classifier.score(docs, vectors, net).collect()] == [0.5] * 4
    assert classifier.score(docs.limit(0), vectors, net).count() == 0


def bucket(word):
    return int(classifier._terms(next(words(pa.array([word]), SPACED, lower=False)))[0][0])


def test_words_outside_the_sample_have_vectors(spark, monkeypatch):
    monkeypatch.setattr(classifier, "SAMPLE", 2)
    docs = spark.createDataFrame([(i, f"only{i} here the word{i} is") for i in range(40)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    vectors, _ = classifier.fit(docs, labels)
    assert all(vectors[bucket(f"{name}{i}")].any() for i in range(40) for name in ("only", "word"))


def test_contexts_equal_a_plain_sum(spark):
    texts = ["a b c a", None, "", "b", "c a a b a", "d"]
    random, plain = classifier.random_vectors().astype(int), {}
    for text in texts:
        w = [bucket(x) for x in (text or "").split()]
        for i, x in enumerate(w):
            plain[x] = plain.get(x, 0) + sum(random[w[k]] for k in range(max(i - 2, 0), min(i + 3, len(w))) if k != i)
    rows = classifier._contexts(iter([pa.record_batch([pa.array(texts[:3])], ["t"]), pa.record_batch([pa.array(texts[3:])], ["t"])]))
    got = {b: v for r in rows for b, *v in zip(*[c.to_pylist() for c in r.columns]) if b < classifier.BUCKETS * 7 // 8}
    assert got == {b: list(v) for b, v in plain.items() if np.any(v)}
