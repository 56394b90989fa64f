"""Documents to token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it kept; all but the last
return the columns of documents. Between stages the rows are written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import decontam, langid, packing, secrets, simhash
from snapmart.llm.common import prepared, staged, table
from snapmart.sources.staging import discard

#: No SQL can train the language model or encode tokens.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter go."""
    prepared(spark)
    return langid.with_language(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    prepared(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.clean_documents(docs, table(prepared(spark), sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and their characters counted anew."""
    prepared(spark)
    masked = secrets.masked(docs)
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    prepared(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_masking),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, staged(stage(spark, docs, sf_dir), name)
        discard(last)  # what a stage kept is of no use once the next one has written
    return STAGES[-1][1](spark, docs, sf_dir)
