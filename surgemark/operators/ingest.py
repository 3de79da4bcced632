"""Operations between a source and the windows: cap, dedupe, retime, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import epoch, from_epoch
from surgemark.operators.prefix import neighbour

MAX_GAP_SECONDS = 5.0
MIN_SPEED = 1e-9


def rate_cap(events: DataFrame, cfg: EngineConfig, arrival: Column | None = None) -> DataFrame:
    """Keep the first N events of each wall second, in arrival order; 0 keeps all.

    The rank filter cuts every second to N rows per map task before the shuffle.
    """
    if cfg.max_events_per_sec <= 0:
        return events
    second = F.floor(epoch(F.col("ts")) if arrival is None else arrival)
    return (
        events.withColumn("_second", second)
        .withColumn("_rn", F.row_number().over(Window.partitionBy("_second").orderBy("seq")))
        .where(F.col("_rn") <= cfg.max_events_per_sec)
        .drop("_second", "_rn")
    )


def rate_drops(events: DataFrame, cfg: EngineConfig, arrival: Column | None = None) -> DataFrame:
    """Events the cap sheds per wall second: counts only, nothing is sorted."""
    second = F.floor(epoch(F.col("ts")) if arrival is None else arrival).cast("long")
    cap = cfg.max_events_per_sec if cfg.max_events_per_sec > 0 else 2 ** 62
    return (
        events.groupBy(second.alias("second"))
        .agg(F.greatest(F.lit(0).cast("long"), F.count(F.lit(1)) - F.lit(cap)).alias("dropped"))
        .where("dropped > 0")
    )


def dedupe(events: DataFrame) -> DataFrame:
    """One event per (source, id): the first to arrive by ``seq``, of those the earliest."""
    first = F.min_by(F.struct("*"), F.struct("seq", "ts"))
    return events.groupBy("source", "id").agg(first.alias("_event")).select("_event.*")


def retime(events: DataFrame, start: float, speed: float = 1.0) -> DataFrame:
    """Shift a recording so its first event happens at ``start``, scaled by ``speed``."""
    base = events.agg(F.min_by(epoch(F.col("ts")), "seq").alias("base")).scalar()
    shifted = F.lit(float(start)) + (epoch(F.col("ts")) - base) / F.lit(max(speed, MIN_SPEED))
    return events.withColumn("ts", from_epoch(shifted))


def replay_gaps(
    events: DataFrame, speed: float = 1.0, chunk_rows: int = 1_000_000
) -> DataFrame:
    """Pause before each event when replaying: capped, 0 for the first or when not paced."""
    if speed <= 0:
        return events.withColumn("gap", F.lit(0.0))
    t = epoch(F.col("ts"))
    chunked = events.withColumn("_all", F.lit(0)).withColumn(
        "_chunk", F.floor(F.col("seq") / F.lit(chunk_rows))
    )
    pause = F.least(F.greatest(F.lit(0.0), t - F.col("_prev")) / F.lit(speed), F.lit(MAX_GAP_SECONDS))
    return (
        neighbour(chunked, ["_all"], "_chunk", "seq", t, "_prev")
        .withColumn("gap", F.coalesce(pause, F.lit(0.0)))
        .drop("_all", "_chunk", "_prev")
    )
