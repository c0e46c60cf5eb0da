import public_tokenizers
from tokenizers import Tokenizer

from paperloom.llm import counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, lang string, tokens int"
ROWS = [(1, "one two", "a", "en", 0), (2, None, None, None, 0), (3, "", "a", "en", 0), (3, "x y z " * 3000, "a", "de", 0), (3, "x y z " * 3000, "a", "de", 0)]


def totals(rollup):
    return {(r.source, r.lang, r.version): (r.documents, r.tokens) for r in rollup.totals().collect()}


def test_batches_add_up_and_can_be_repeated(spark, tmp_path):
    first = counts.count_tokens(spark.createDataFrame(ROWS, SCHEMA), "v1", PATH)
    plain = Tokenizer.from_file(PATH)
    size = [len(plain.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in ROWS]
    rollup = counts.Rollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == {}
    assert rollup.commit("day 1/2", counts.inserted(first)) and not rollup.commit("day 1/2", counts.inserted(first))
    want = {("a", "en", "v1"): (2, size[0]), (None, None, "v1"): (1, 0), ("a", "de", "v1"): (2, 2 * size[3])}
    assert totals(rollup) == want
    one = counts.count_tokens(spark.createDataFrame(ROWS[:1], SCHEMA), "v2", PATH)
    rollup.commit("revision", counts.revised(first.where("doc_id = 1"), one))
    rollup.commit("gone", counts.deleted(first.where("lang = 'de'")))
    rollup.commit("empty", counts.deleted(first.limit(0)))
    assert totals(rollup) == {("a", "en", "v1"): (1, 0), (None, None, "v1"): (1, 0), ("a", "en", "v2"): (1, size[0])}


def test_what_a_failed_job_left_is_replaced(spark, tmp_path):
    first = counts.count_tokens(spark.createDataFrame(ROWS, SCHEMA), "v1", PATH)
    rollup = counts.Rollup(spark, str(tmp_path / "r"))
    rollup.commit("b", counts.inserted(first))
    next((tmp_path / "r").glob("batch-*/_SUCCESS")).unlink()
    assert totals(rollup) == {} and not rollup.committed("b")
    assert rollup.commit("b", counts.inserted(first)) and totals(rollup)[("a", "en", "v1")][0] == 2
