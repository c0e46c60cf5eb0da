"""Queries of the operators over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import classifier, counts, decontaminate, lm, maxscore, merkle, minhash, packing, periods, pii, rules, secret_scan, warc
from paperloom.llm.oracle import ORACLE_SQL
from paperloom.llm.staging import staged, table
from paperloom.plans.staging import scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents came, every tenth was recounted with another tokenizer,
    every tenth went, and the first batch was sent twice."""
    docs = table(spark, sf_dir, "documents")
    first = counts.count_tokens(docs, "byte_bpe_50k", public_tokenizers.path("byte_bpe_50k.json"))
    first = staged(first, "counts")
    second = counts.count_tokens(docs.where("doc_id % 10 = 3"), "word_bpe_49k", public_tokenizers.path("word_bpe_49k.json"))
    rollup = counts.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("come", counts.inserted(first))
    rollup.commit("recounted", counts.revised(first.where("doc_id % 10 = 3"), second))
    rollup.commit("gone", counts.deleted(first.where("doc_id % 10 = 7")))
    rollup.commit("come", counts.inserted(first))
    return rollup.totals()


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform(F.coalesce("items", F.array()), lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), keep_columns=["doc_id"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[f"rules.{x}" for x in names])


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = lm.fit(docs.where(~held_out))
    return lm.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.totals.n).cast("long").alias("train_tokens"),
        "base_score", "score")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    vectors, net = classifier.fit(docs, labels.where(~held_out))
    return classifier.score(docs, vectors, net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the archives of all pages and of their damaged copies, both read back as bytes.

    Some copies have other bytes in a record, a wrong Content-Length, lack a byte in the
    middle (what is behind it moves), or end within the last record but one."""
    placed = warc.records(table(spark, sf_dir, "pages"))
    sites = [scratch_path(spark, f"warc-{x}") for x in ("ours", "copies")]
    warc.write_warc(placed, sites[0])
    head = F.substring_index(F.col("record").cast("string"), warc.BREAK, 1)
    seen = warc.read_warc(spark, sites[0]).select(
        "archive", "ordinal", "start", "length", F.octet_length(head).alias("head"), F.translate(F.substring(head, -1, 1), "0123456789", "9876543210").alias("digit"),
        F.expr("substring(record, -1, 1) = X'3E'").alias("closed"))
    known = staged(seen.join(placed.select("archive", "ordinal", "id"), ["archive", "ordinal"]), "known")
    known = known.join(known.groupBy("archive").agg(F.count("*").alias("n")), "archive")

    def edit(hit: str, at: Column, drop: int, put: Column) -> DataFrame:
        return known.where(hit).select("archive", (F.col("start") + at).alias("at"), F.lit(drop).cast("long").alias("drop"), put.cast("binary").alias("put"))

    edits = (edit("id % 101 = 7 and closed", F.col("length") - 5, 1, F.lit("~"))
             .unionAll(edit("id % 211 = 5", F.col("head") - 1, 1, F.col("digit")))
             .unionAll(edit("archive % 5 = 2 and ordinal = n div 2", F.lit(7), 1, F.lit("")))
             .unionAll(edit("archive % 3 = 1 and ordinal = greatest(n - 2, 0)", F.lit(20), 1 << 62, F.lit(""))))
    warc.copy_spliced(spark, *sites, edits)
    return warc.audit(*[warc.read_warc(spark, site) for site in sites])


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_personal_data(docs).select(
        "doc_id", "text", F.array_join(F.transform(F.array_sort(F.map_entries("pii")), lambda e: F.concat_ws(
            ":", e["key"], e["value"].cast("string"))), ",").alias("entities"))


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = secret_scan.KINDS[:3]
    counts = [_count(kind).cast("long").alias(f"n_{kind}") for kind in base]
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(secret_scan.joined("spans", base), 256).alias("base_sha256"), secret_scan.joined("spans").alias("spans"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, tried on documents half of which lost their line ends."""
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    fields = ["doc_id", "source", "lang", "n_chars"]
    tampered = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "source", merkle.digest_of(*map(F.col, fields), F.col("text")).alias("leaf"),
                         merkle.digest_of(*map(F.col, fields), tampered).alias("found"))
    proven = merkle.prove(leaves).withColumn("folded_root", merkle.folded(F.col("found"), F.col("proof")))
    return proven.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), k=5, divisor=50, scale=256.0)


def _made_periodic(text: Column, hashed: Column) -> Column:
    """The words of a text, from a place on repeated with a period."""
    g = F.floor(hashed / 10)

    def of(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")).otherwise("")

    return F.element_at(F.transform(F.array(F.array_remove(F.split(text, rules.GAP), "")), of), 1)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, one in ten of which is made periodic."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when((hashed % 10 == 0) & F.col("text").isNotNull(), _made_periodic(F.col("text"), hashed)).otherwise(F.col("text"))
    found = periods.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op9_secret_scans": op9_secret_scans,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_periodic_runs": op13_periodic_runs,
}
