"""Derived series for charts and tiles over gap-filled, scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import epoch
from surgemark.operators.history import last_n
from surgemark.operators.prefix import neighbour, slice_rows

TREND_LOOKBACK = 30
TREND_BAND = 0.02
AGREEMENT_WINDOWS = 48
SCORE_WINDOWS = 60
CHART_SECONDS = 120.0
STALE_SECONDS = 4.0
SLICE = 8_192


def trend(
    windows: DataFrame, column: str = "rate", lookback: int = TREND_LOOKBACK, length: int = SLICE
) -> DataFrame:
    """Relative change against the value ``lookback`` windows ago, per window.

    Null while history is short or the past value is zero; moves inside the dead band
    have direction ``flat``.
    """
    x = F.col(column).cast("double")
    line = Window.partitionBy("series", "slice").orderBy("window_id")
    past = F.lag(x, lookback).over(line)
    delta = F.when(F.col("_past") != 0, (x - F.col("_past")) / F.col("_past"))
    return (
        slice_rows(windows.select("series", "window_id", column), lookback, length)
        .withColumn("_past", past)
        .where("in_slice")
        .withColumn("trend", delta)
        .select(
            "series", "window_id", F.col(column), "trend",
            F.when(F.col("trend") > TREND_BAND, "up")
            .when(F.col("trend") < -TREND_BAND, "down")
            .when(F.col("trend").isNotNull(), "flat").alias("direction"),
        )
    )


def agreement(scored: DataFrame, n: int = AGREEMENT_WINDOWS) -> DataFrame:
    """How many detectors flagged each of the last ``n`` windows, and how many could."""
    return last_n(scored, n).select(
        "series", "window_id",
        F.size(F.filter("detectors", lambda d: d["flag"])).alias("agreement"),
        F.size(F.filter("detectors", lambda d: ~F.coalesce(d["detail"]["unavailable"], F.lit(False))))
        .alias("available"),
    )


def detector_scores(scored: DataFrame, names: tuple[str, ...], n: int = SCORE_WINDOWS) -> DataFrame:
    """One score column per detector over the last ``n`` windows, 0 where missing."""
    def score(name: str):
        hit = F.filter("detectors", lambda d: d["name"] == name)
        return F.coalesce(F.get(hit, 0)["score"], F.lit(0.0)).alias(name)

    return last_n(scored, n).select("series", "window_id", *[score(name) for name in names])


def sparkline(windows: DataFrame, column: str = "rate", n: int = SCORE_WINDOWS) -> DataFrame:
    """Last ``n`` values scaled into a 100x100 box, y downwards; none for a single point."""
    everything = Window.partitionBy("series")
    order = everything.orderBy("window_id")
    v = F.col(column).cast("double")
    return (
        last_n(windows.select("series", "window_id", column), n)
        .withColumn("_n", F.count(F.lit(1)).over(everything))
        .withColumn("_lo", F.min(v).over(everything))
        .withColumn("_span", F.max(v).over(everything) - F.col("_lo"))
        .withColumn("_i", F.row_number().over(order) - 1)
        .where("_n >= 2")
        .select(
            "series", "window_id",
            (F.col("_i") * (F.lit(100.0) / (F.col("_n") - 1))).alias("x"),
            (F.lit(100.0) - (v - F.col("_lo"))
             / F.when(F.col("_span") == 0, 1.0).otherwise(F.col("_span")) * 100.0).alias("y"),
        )
    )


def series_summary(windows: DataFrame, chart_seconds: float = CHART_SECONDS) -> DataFrame:
    """Peak rate, total events and the chart's axis ranges per series.

    The y limit covers the rates inside the visible x range.
    """
    bounds = windows.groupBy("series").agg(
        F.max("rate").alias("peak_rate"), F.sum("count").alias("total_events"),
        F.max("window_end").alias("x_max"),
    )
    visible = (
        windows.select("series", "rate", "window_end")
        .join(bounds.select("series", "x_max"), "series")
        .where(F.col("window_end") >= F.col("x_max") - chart_seconds)
        .groupBy("series").agg(F.max("rate").alias("_seen"))
    )
    return bounds.join(visible, "series").select(
        "series", "peak_rate", "total_events",
        (F.col("x_max") - chart_seconds).alias("x_min"), "x_max",
        F.greatest(F.lit(5.0), F.col("_seen") * 1.15).alias("y_max"),
    )


def chart_markers(
    anomalies: DataFrame, windows: DataFrame, chart_seconds: float = CHART_SECONDS
) -> DataFrame:
    """Anomalies inside the visible time range of their series."""
    ends = windows.groupBy("series").agg(F.max("window_end").alias("_x_max"))
    return anomalies.join(ends, "series").where(
        F.col("ts").between(F.col("_x_max") - chart_seconds, F.col("_x_max"))
    ).drop("_x_max")


def stale_intervals(rows: DataFrame, cfg: EngineConfig, ts: str = "ts", chunk: int = 8_192) -> DataFrame:
    """Silences longer than max(4 s, 4 ticks) in a feed.

    Times fall into buckets as wide as the limit. A silence over the limit cannot fit in
    one bucket, so the first and last time of each bucket (combined map-side) are all
    that is ever ordered.
    """
    limit = max(STALE_SECONDS, 4.0 * cfg.tick_seconds)
    buckets = (
        rows.select("series", epoch(F.col(ts)).alias("_t"))
        .where(F.col("_t").isNotNull())
        .groupBy("series", F.floor(F.col("_t") / F.lit(limit)).alias("_bucket"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
        .withColumn("_chunk", F.floor(F.col("_bucket") / F.lit(chunk)))
    )
    return (
        neighbour(buckets, ["series"], "_chunk", "_bucket", F.col("_first"), "_resume", step=1)
        .where(F.col("_resume") - F.col("_last") > limit)
        .select(
            "series", F.col("_last").alias("silent_from"), F.col("_resume").alias("silent_to"),
            (F.col("_resume") - F.col("_last")).alias("silent_seconds"),
        )
    )
