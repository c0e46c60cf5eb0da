"""The corpus pipeline: documents in, packed sequences of clean documents out.

Every stage takes what its predecessor kept, as a table read back from Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, minhash, packing, pii, rules
from paperloom.llm.staging import staged, table, unused


# Every stage keeps the columns of its input, extra ones included, and rows as often as they
# came, unless it says otherwise. Rows with a null id stay by themselves; an empty table
# stays empty.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules. Null and empty texts do not."""
    return rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates. Rows of one id
    stay or go together; null and empty texts are like nothing else and stay."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages. Null and empty texts stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; n_chars follows the new text.
    Null and empty texts stay as they are."""
    (kinds,) = unused(docs, "_kinds")
    replaced = pii.replace_personal_data(docs, into=kinds).drop(kinds)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their places in sequences of 2048 tokens. Null and
    empty texts are just the end id."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("decontamination", decontamination),
    ("personal data", private),
    ("packing", packed),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{k}")
    return docs
