"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of documents, for the documents that they keep, whatever further columns
there are. A null or empty text has fewer words than the limits ask for and goes in the first stage, as do documents without
a key whose text fails it. Rows repeated under one key with one text leave the second stage once. Texts are processed whole.
An empty table goes through all stages and stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.llm import bpe, decontaminate, jaccard, personal_data, quality_rules
from benchloom.llm.shared import new_folder
from benchloom.llm.ship import spare


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Quality rules: documents that fail the limits or the fitted trees go."""
    rules = quality_rules.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    result = spare(docs, "rules")
    return quality_rules.assess(docs, rules, result=result).where(F.col(result)["kept"]).drop(result)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """N-gram Jaccard join: of each class of similar documents the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Benchmark decontamination: documents of which a twentieth or more stands in benchmark items go."""
    result = spare(docs, "hits")
    found = decontaminate.hits(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), result=result)
    hits = F.col(result)
    return found.where(~decontaminate.contaminated(hits["n_words"], hits["n_hit"])).drop(result)


def personal_data_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data: every document stays, with the entities masked."""
    clean = personal_data.redact(docs)
    return clean.select(
        *(F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns)
    )


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Byte-level BPE: the ids of each text, and a hash of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(docs, *ranks).select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("tokens", token_stage),
]

#: The rows depend on fitted trees and on a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order over the whole of ``documents``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    written = new_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{written}/{name}")
        docs = spark.read.parquet(f"{written}/{name}")
    return STAGES[-1][1](spark, docs, folder)
