"""A corpus pipeline over ``documents``, made of the operators in ``rillflow.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents that it keeps, with the columns of
``documents``; the last one returns ids of tokens. The result of each stage is written and read again, so a lost executor
costs one stage at most, and no plan grows with the number of stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.bpe import encode_decode, token_count
from rillflow.llm.decontamination import decontaminate
from rillflow.llm.line_dedup import SOLID, drop_repeated_lines
from rillflow.llm.quality_rules import keep_good
from rillflow.llm.queries import ship_package
from rillflow.llm.simhash import keep_one
from rillflow.workspace import land

MIN_LINES = 3
# Shorter runs of lines are repeated passages too if they have more words than this.
LONG_WORDS = 50
# Near duplicates: fingerprints over shingles of four words that differ in four bits or fewer.
NEAR = {"radius": 4, "shingle": 4}
VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough words and little repetition."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; a document of which no word is left goes."""
    cut = drop_repeated_lines(docs, MIN_LINES, long_words=LONG_WORDS)
    return cut.where(F.col("text").rlike(SOLID)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs, **NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``."""
    done = encode_decode(docs, public_tokenizers.path(VOCABULARY))
    return done.select("doc_id", token_count("ids").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe", bpe),
]

# SQL has no byte-pair encoding; the tests hold the rows against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
