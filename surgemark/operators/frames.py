"""Wire frames: rounded, denormalised projections of windows and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.functions.scalar import half_up

FRAME_DIMS = ("domain", "lang")
FRAME_TOP = 6


def leading_values(dim_counts: Column) -> Column:
    """``dim -> [(value, cnt), ...]`` cut to the frame dimensions and their first values."""
    top = F.transform_values(
        F.map_filter(dim_counts, lambda k, v: k.isin(*FRAME_DIMS)), lambda k, v: F.slice(v, 1, FRAME_TOP))
    return F.coalesce(top, F.create_map().cast("map<string,array<struct<value:string,cnt:bigint>>>"))


def metric_frame(scored: DataFrame, nested_dims: DataFrame | None = None) -> DataFrame:
    """Compact per-window message; ``top`` keeps the leading values of two dimensions."""
    frame = scored
    if nested_dims is not None:
        frame = scored.join(nested_dims, ["series", "window_id"], "left")
        frame = frame.withColumn("top", leading_values(F.col("dim_counts")))
    detectors = F.transform("detectors", lambda d: F.struct(
        d["name"].alias("name"), half_up(d["score"], 4).alias("score"), d["flag"].alias("flag"),
        d["detail"]["z"].alias("z"),
        (~F.coalesce(d["detail"]["unavailable"], F.lit(False))).alias("available"),
    ))
    return frame.select(
        F.lit("metric").alias("type"), "series",
        half_up(F.col("window_end"), 3).alias("t"), half_up(F.col("window_start"), 3).alias("ws"),
        half_up(F.col("rate"), 3).alias("rate"), "count", "distinct_subjects", "distinct_actors",
        half_up(F.col("bot_ratio"), 4).alias("bot_ratio"),
        half_up(F.col("bytes_per_sec"), 1).alias("bytes_per_sec"),
        half_up(F.col("new_rate"), 3).alias("new_rate"),
        detectors.alias("detectors"),
        *([F.col("top")] if nested_dims is not None else []),
    )


def anomaly_frame(anomalies: DataFrame) -> DataFrame:
    hidden = ("available", "window_id")
    return anomalies.select(
        F.lit("anomaly").alias("type"), *[c for c in anomalies.columns if c not in hidden]
    )


def as_json(frame: DataFrame) -> DataFrame:
    return frame.select(F.to_json(F.struct(*frame.columns)).alias("value"))
