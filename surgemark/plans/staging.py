"""Cut long lineage with a written table in the cluster's shared folder.

A stage is a parquet table under ``spark.checkpoint.dir``: it survives executor loss,
carries statistics for the next plan, and is read column by column. The folder always
comes from the session. A session that sets none stages beside its tables, under
``spark.sql.warehouse.dir``, which driver and executors share as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def stage_root(spark: SparkSession) -> str:
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_surgemark_stage"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the stored copy."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
