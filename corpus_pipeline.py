"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate
removal, mixing, byte-level BPE.

Each stage reads what the one before wrote. The first four return the columns
of ``documents``; the last returns a row of token counts and digests per
document of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import load, stored
from basketlens.llm.line_dedup import dedup_lines
from basketlens.llm.mixing import mixed_documents
from basketlens.llm.near_duplicates import deduplicated
from basketlens.llm.quality_rules import passing
from basketlens.llm.queries import bpe_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 or more documents go; n_chars follows the text. Every
    document stays; a null text stays null."""
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    out = dedup_lines(docs, threshold=10).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return deduplicated(docs, percent=75)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them (not at all, once, twice); a
    part of a document is its chance of one more copy."""
    return mixed_documents(docs, even=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded mix."""
    return bpe_digests(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near-copies", near_copies),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Shingle similarity, cuckoo filters, seeded mixing and BPE have no SQL form:
# tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
