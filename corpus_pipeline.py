"""The text pipeline: each stage works on what the one before it kept.

toxicity drops toxic documents, exact_dedup keeps one of equal texts, near_dedup one of each
near-duplicate group, repeats cuts repeated passages of over 50 words or from 400 bytes, and packing lays what is left out
in sequences. All but the last return the columns of ``documents``. A stage's result is
written to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surgemark.llm import exact_dedup, packing, repeats, simhash, toxicity
from surgemark.llm.common import table
from surgemark.plans.staging import stage


PASSAGE = 51                  # words from which a shared passage is long; so are repeats.LENGTH bytes


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_survivors(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(docs, words=PASSAGE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

# Learned scores, fingerprints and packing have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
