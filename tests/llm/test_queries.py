"""Every query over the small tables: against its SQL, or against a plain version."""

import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from paperloom.llm import queries
from tests.compare import connect, differences
from tests.llm.helpers import classes, hits
from tests.llm.test_rules import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert differences(spark, connect(SF), name, SF) == []


def test_all_are_registered():
    assert {x.split("_")[0] for x in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op5_lm_scoring", "op6_quality_classifier", "op9_secret_scans", "op8_pii_surrogates"])
def test_one_row_per_document(spark, name):
    ids = sorted(r.doc_id for r in queries.QUERIES[name](spark, SF).collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_token_counts(spark):
    plain_ = {v: Tokenizer.from_file(public_tokenizers.path(f"{v}.json")) for v in ("byte_bpe_50k", "word_bpe_49k")}
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 10 <> 7").collect():
        version = "word_bpe_49k" if r.doc_id % 10 == 3 else "byte_bpe_50k"
        n = len(plain_[version].encode(r.text, add_special_tokens=False).ids)
        old = want.get((r.source, r.lang, version), (0, 0))
        want[r.source, r.lang, version] = (old[0] + 1, old[1] + n)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in queries.op2_token_counts(spark, SF).collect()} == want


def test_pipeline_stages(spark):
    """Each stage against a plain version of its decisions, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "decontamination", "personal data", "packing"]
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], SF)
        assert out.columns == docs.columns
        seen.append(spark.createDataFrame(out.collect(), docs.schema))
    ids = [{r.doc_id for r in d.collect()} for d in seen]
    for r in docs.collect():
        n, _, _, _, repeated = plain(r.text)
        assert not (n < 50 or 2 * repeated > n) or r.doc_id not in ids[1]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    assert all(r.doc_id in ids[1] for r in docs.collect() if r.doc_id in good and plain(r.text)[0] >= 50 and 2 * plain(r.text)[4] <= plain(r.text)[0])
    texts = [(r.doc_id, r.text) for r in seen[1].collect()]
    assert ids[2] == {d for d, (_, c) in classes(texts, 5, 80).items() if d == c}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[3] == {d for d, _, hit, _ in hits([(r.doc_id, r.text) for r in seen[2].collect()], bench) if not hit}
    assert ids[4] == ids[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, seen[-1], SF).collect()
    assert {r.doc_id for r in packed} == ids[4]
    assert json.dumps(sorted({r.doc_id for r in corpus_pipeline.run(spark, SF).collect()})) == json.dumps(sorted(ids[4]))
