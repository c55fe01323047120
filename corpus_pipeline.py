"""A training corpus from raw documents, in stages: each calls one of the training-data operators, on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared folder and read
again as the next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.bpe import Tokenizer
from tidewatch.llm.common import documents, materialize
from tidewatch.llm.decontaminate import decontaminate
from tidewatch.llm.exact_dedup import exact_dedup
from tidewatch.llm.quality import keep_quality
from tidewatch.llm.simhash import near_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.5 or more."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of equal texts (A-Z lower-cased)."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by a Jaccard similarity of 0.8 or more of 5-word shingles."""
    return near_dedup(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item, substitutions tolerated."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, ids, and decoded: the text that the ids decode to."""
    tokenizer = Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = tokenizer.encode(docs.select("doc_id", "text"), decoded_col="decoded")
    return both.selectExpr("doc_id", "text", "ids", "decode(decoded, 'UTF-8') as decoded")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean_of_benchmarks), ("tokens", tokens)]

#: The first stage is a trained model, which SQL can't express; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
