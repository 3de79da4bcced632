"""Small helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
