"""Decaying per-value baselines and the ranked "why" of an anomaly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import half_up

KEY = ["series", "dim", "value", "slice"]
BLOCK = 64


def sliced_sightings(topk: DataFrame, cfg: EngineConfig, length: int) -> DataFrame:
    """Sightings of each value per time slice, with the halo that decays to nothing."""
    wid, size = F.col("window_id"), F.lit(length)
    return topk.select(
        "series", "dim", "value",
        F.explode(F.sequence(
            F.floor(wid / size), F.floor((wid + F.lit(cfg.baseline_halo)) / size)
        )).alias("slice"),
        "window_id", "cnt", "rk",
    )


def _levels(seen: Column, cfg: EngineConfig) -> Column:
    """The baseline before each sighting of ``seen``, (window_id, cnt, ...) in order of windows.

    The fold holds the last window, its count and the baselines so far; those are appended in
    blocks, so that what is copied does not grow with the square of the sightings.
    """
    keep, gain, prune = F.lit(1.0 - cfg.baseline_alpha), F.lit(cfg.baseline_alpha), F.lit(cfg.baseline_prune)

    def before(s: Column, x: Column) -> Column:
        level = keep * F.element_at(s["levels"], -1) + gain * s["cnt"]
        gap = x["window_id"] - s["last"] - 1
        decayed = level * F.pow(keep, gap)
        return F.when(gap <= 0, level).when(decayed < prune, 0.0).otherwise(decayed)

    def step(s: Column, x: Column) -> Column:
        return F.struct(x["window_id"].alias("last"), x["cnt"].alias("cnt"),
                        F.array_append(s["levels"], before(s, x)).alias("levels"))

    def block(s: Column, rows: Column) -> Column:
        start = F.struct(s["last"], s["cnt"], F.array(s["level"]).alias("levels"))
        return F.aggregate(rows, start, step, lambda e: F.struct(
            e["last"], e["cnt"], F.element_at(e["levels"], -1).alias("level"),
            F.array_append(s["done"], F.slice(e["levels"], 2, BLOCK)).alias("done")))

    start = F.struct(
        (F.get(seen, 0)["window_id"] - 1).alias("last"), F.lit(0).cast("long").alias("cnt"),
        F.lit(0.0).alias("level"), F.array().cast("array<array<double>>").alias("done"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(seen) - 1) / BLOCK).cast("int")),
                         lambda i: F.slice(seen, i * BLOCK + 1, BLOCK))
    return F.aggregate(blocks, start, block, lambda e: F.flatten(e["done"]))


def scan_baselines(sightings: DataFrame, cfg: EngineConfig, length: int) -> DataFrame:
    """Baseline of each value just before each sighting.

    Between sightings ``g`` unseen windows apart the baseline only decays, and a value
    that falls under the prune level while unseen is forgotten, so the work follows
    sightings, not windows x values. A value's sightings in one slice, at most ``length`` and
    the halo of them, are folded in the JVM.
    """
    folded = (
        sightings.groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("window_id", "cnt", "rk"))).alias("seen"))
        .withColumn("level", _levels(F.col("seen"), cfg))
    )
    return (
        folded.select(*KEY, F.explode(F.arrays_zip("seen", "level")).alias("s"))
        .where(F.col("s.seen.window_id") >= F.col("slice") * length)
        .select("series", "s.seen.window_id", "dim", "value", "s.seen.cnt", "s.seen.rk",
                F.col("s.level").alias("baseline"))
    )


def baselines(topk: DataFrame, cfg: EngineConfig, length: int | None = None) -> DataFrame:
    """All sightings with the baseline each value had before its window."""
    length = length or 8 * cfg.baseline_halo
    return scan_baselines(sliced_sightings(topk, cfg, length), cfg, length)


def contributions(sightings: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Rank the values whose count most exceeds their baseline, per window.

    Shares are taken within a dimension over every kept value, before the cut to top N.
    """
    dim_pos = F.coalesce(
        F.array_position(F.array(*[F.lit(d) for d in cfg.track_dims]), F.col("dim")), F.lit(0)
    )
    kept = (
        sightings.where(F.col("cnt") - F.col("baseline") >= cfg.why_min_excess)
        .withColumn("excess", half_up(F.col("cnt") - F.col("baseline"), 2))
        .withColumn("baseline", half_up(F.col("baseline"), 2))
    )
    within = Window.partitionBy("series", "window_id", "dim")
    order = Window.partitionBy("series", "window_id").orderBy(
        F.col("excess").desc(), F.col("_pos"), F.col("rk")
    )
    total = F.sum(F.col("excess").cast("decimal(28,2)")).over(within).cast("double")
    return (
        kept.withColumn("_total", total)
        .withColumn(
            "share",
            half_up(F.col("excess") / F.when(F.col("_total") == 0, 1.0).otherwise(F.col("_total")), 4),
        )
        .withColumn("_pos", dim_pos)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= cfg.why_top_n)
        .select("series", "window_id", "rank", "dim", "value",
                F.col("cnt").alias("observed"), "baseline", "excess", "share")
    )


def nest_contributions(ranked: DataFrame) -> DataFrame:
    """One row per window with ``why`` as an ordered array."""
    item = F.struct("rank", "dim", "value", "observed", "baseline", "excess", "share")
    return ranked.groupBy("series", "window_id").agg(
        F.transform(
            F.array_sort(F.collect_list(item)),
            lambda c: F.struct(*[c[n].alias(n) for n in
                                 ("dim", "value", "observed", "baseline", "excess", "share")]),
        ).alias("why")
    )
