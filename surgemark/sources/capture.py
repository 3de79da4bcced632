"""Captured server-sent-event files as a table of (event id, data) frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def _field(line, name: str):
    """Value of a ``name: value`` line, one leading space removed; NULL for other lines."""
    text = F.when(line.startswith(f"{name}:"), F.substr(line, F.lit(len(name) + 2)))
    text = F.when(line == name, F.lit("")).otherwise(text)
    return F.when(text.startswith(" "), F.substr(text, F.lit(2))).otherwise(text)


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """Frames with data, each under the last ``id:`` seen so far in its file.

    Files are read line by line, so any line ending works and splits are read in parallel.
    A line belongs to the frame numbered by the blank lines before it; that count and the
    current id are running values inside a split plus what the earlier splits of the file
    bring along, for which one row per split is sequenced. A last frame without its
    closing blank line is incomplete and dropped.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        (F.col("value") == "").alias("_blank"),
        _field(F.col("value"), "id").alias("_id"),
        _field(F.col("value"), "data").alias("_data"),
    )
    splits = Window.partitionBy("file").orderBy("block")
    before = splits.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        lines.groupBy("file", "block").agg(
            F.count_if("_blank").alias("_n"),
            F.max(F.when(F.col("_id").isNotNull(), F.struct("pos", "_id"))).alias("_last"),
        )
        .select(
            "file", "block",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_frames"),
            F.last("_last", ignorenulls=True).over(before)["_id"].alias("_carry"),
        )
    )
    inside = Window.partitionBy("file", "block").orderBy("pos")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        lines.join(heads, ["file", "block"], "left")
        .withColumn("frame", F.col("_frames") + F.coalesce(
            F.sum(F.col("_blank").cast("long")).over(earlier), F.lit(0)))
        .withColumn("event_id", F.coalesce(F.last("_id", ignorenulls=True).over(upto), "_carry"))
    )
    data = F.when(F.col("_data").isNotNull(), F.struct("block", "pos", "_data"))
    return (
        numbered.where(F.col("_blank") | F.col("_id").isNotNull() | F.col("_data").isNotNull())
        .groupBy("file", "frame").agg(
            F.array_sort(F.collect_list(data)).alias("_lines"),
            F.bool_or("_blank").alias("_closed"),
            F.max(F.when(F.col("_blank"), F.col("event_id"))).alias("event_id"),
        )
        .where(F.col("_closed") & (F.size("_lines") > 0))
        .select("file", "frame", "event_id",
                F.array_join(F.transform("_lines", lambda r: r["_data"]), "\n").alias("data"))
    )
