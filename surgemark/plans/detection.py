"""Events in, scored windows and explained anomalies out: one batch plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from surgemark.config import EngineConfig
from surgemark.operators.detectors import get_detector
from surgemark.operators.detectors.base import unavailable_struct
from surgemark.operators.ensemble import anomaly_records, apply_cooldown, ensemble
from surgemark.operators.explain import (
    baselines, contributions, nest_contributions, scan_baselines, sliced_sightings,
)
from surgemark.operators.windows import (
    WINDOW_COLUMNS, dense_slices, dim_counts, dim_topk, place_events, window_metrics,
)
from surgemark.plans.staging import stage
from surgemark.schemas import CONTRIBUTION


@dataclass(frozen=True)
class Detection:
    windows: DataFrame      # gap-filled metrics with the ``detectors`` array
    anomalies: DataFrame    # records with ``detectors`` and ``why``

    @property
    def results(self) -> DataFrame:
        """Long form: one row per window and detector."""
        return explode_results(self.windows)


def explode_results(scored: DataFrame) -> DataFrame:
    return scored.select(
        "series", "window_id", "metric", F.col("window_end").alias("ts"),
        F.inline("detectors"),
    )


def score_windows(
    windows: DataFrame, cfg: EngineConfig, flush_to: float | None = None
) -> DataFrame:
    """Run every configured detector over gap-filled windows.

    Slices carry enough history for all detectors, so scalar detectors cost one shuffle
    and one sort of compact window rows, however long a single series is.
    """
    names = [n for n in cfg.detectors if n not in cfg.unavailable]
    active = [get_detector(n) for n in names]
    halo = max([cfg.halo, *[d.history(cfg) for d in active]])
    frame = dense_slices(windows, cfg, flush_to, halo=halo)
    for d in active:
        frame = d.prepare(frame, cfg)
    for d in active:
        frame = d.apply(frame, cfg)
    value = F.col(cfg.value_metric).cast("double")
    results = [
        F.col(n) if n in names else unavailable_struct(n, value) for n in cfg.detectors
    ]
    fired = F.lit(False)
    for n in names:
        fired = fired | F.col(n)["flag"]
    return frame.where("in_slice").select(
        *WINDOW_COLUMNS, F.lit(cfg.primary_metric).alias("metric"), value.alias("value"),
        F.array(*results).alias("detectors"), fired.alias("fired"),
    )


def surfaced_windows(scored: DataFrame, cfg: EngineConfig, staged: bool = False) -> DataFrame:
    """Ensemble and cooldown. The cooldown reads its candidates more than once, so with
    ``staged`` the (rare) candidates are stored first instead of being scored again."""
    candidates = ensemble(scored, cfg)
    if staged:
        candidates = stage(candidates, "candidates")
    return anomaly_records(apply_cooldown(candidates, cfg))


def why_for(
    surfaced: DataFrame, events: DataFrame, cfg: EngineConfig,
    series_cols: Sequence[str] = (), prune: bool = False,
) -> DataFrame:
    """Ranked contributions of each surfaced window.

    A baseline forgets everything older than its halo, so only events in the time bucket
    of an anomaly and the bucket before matter. With ``prune`` (``surfaced`` is a stored
    table) a semi-join drops all other events ahead of the dimension explode; whether the
    buckets are broadcast or shuffled is left to the planner.
    """
    length = cfg.baseline_halo
    targets = surfaced.select("series", "window_id").distinct()
    placed = place_events(events, cfg, series_cols)
    slices = targets.select(
        "series", F.floor(F.col("window_id") / F.lit(length)).alias("slice")
    ).distinct()
    if prune:
        near = slices.select(
            "series", F.explode(F.array(F.col("slice") - 1, F.col("slice"))).alias("_bucket")
        ).distinct()
        placed = (
            placed.withColumn("_bucket", F.floor(F.col("window_id") / F.lit(length)))
            .join(near, on=["series", "_bucket"], how="left_semi")
            .drop("_bucket")
        )
    topk = dim_topk(dim_counts(events, cfg, series_cols, placed=placed), cfg)
    sightings = sliced_sightings(topk, cfg, length).join(slices, ["series", "slice"], "left_semi")
    levels = scan_baselines(sightings.select(
        "series", "dim", "value", "slice", "window_id", "cnt", "rk"), cfg, length)
    return contributions(levels.join(targets, ["series", "window_id"], "left_semi"), cfg)


def attach_why(surfaced: DataFrame, ranked: DataFrame) -> DataFrame:
    none = F.array().cast(f"array<{CONTRIBUTION.simpleString()}>")
    return (
        surfaced.join(nest_contributions(ranked), ["series", "window_id"], "left")
        .withColumn("why", F.coalesce(F.col("why"), none))
    )


def detect_anomalies(
    events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = (),
    flush_to: float | None = None, staged: bool = True,
) -> Detection:
    """The whole pipeline.

    ``staged`` writes compact tables (non-empty windows, candidates, anomalies), so raw
    events are read once for metrics and once, pruned to anomalous time buckets, for
    dimensions. Unstaged, everything is one lazy plan.
    """
    windows = window_metrics(events, cfg, series_cols)
    if staged:
        windows = stage(windows, "windows")
    scored = score_windows(windows, cfg, flush_to)
    surfaced = surfaced_windows(scored, cfg, staged)
    if staged:
        surfaced = stage(surfaced, "surfaced")
    ranked = why_for(surfaced, events, cfg, series_cols, prune=staged)
    return Detection(windows=scored, anomalies=attach_why(surfaced, ranked))


def all_baselines(
    events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = ()
) -> DataFrame:
    return baselines(dim_topk(dim_counts(events, cfg, series_cols), cfg), cfg)
