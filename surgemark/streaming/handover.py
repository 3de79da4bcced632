"""Hand-over from batch to stream: the scorer's state after a history, worked out as a batch.

The stream's state forgets. The z-score keeps its window; what EWMA has forgotten weighs under
1e-50 after its halo; the trees need the block before the current one and the running extremes
of each feature. So of each series only a tail of bounded length is gone through in order; of
everything before it only the extremes count, an ordinary aggregation. Levels of dimension
values follow from each value's last sighting and its baseline there (``explain.baselines``).

The result has one row with ``core`` for each series and one row for each remembered value of a
dimension (``dim``, ``value``, ``level``, ``last``), for ``score_stream(..., initial=...)``.
Series without windows have no state; an empty history gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from surgemark.config import FEATURES, EngineConfig
from surgemark.operators.detectors.hst import split_table
from surgemark.operators.explain import baselines
from surgemark.operators.windows import COUNTS, derived_columns
from surgemark.plans.staging import stage
from surgemark.streaming.scoring import STATE, WindowScorer, ewma_step

CORE = T.StructType([T.StructField("series", T.StringType()), T.StructField("core", STATE)])


def tail_length(cfg: EngineConfig) -> int:
    """Windows that decide the state at the end of a series."""
    return max(cfg.ewma_halo, cfg.zscore_window, 2 * cfg.hst_window)


def _with_bounds(windows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Windows with the first one, the last one, and where the tail starts: on a block of the
    trees, so that blocks count as they do from the first window on."""
    bounds = windows.groupBy("series").agg(
        F.min("window_id").alias("lo"), F.max("window_id").alias("hi"))
    spare = F.greatest(F.lit(0), F.col("hi") - F.col("lo") + 1 - F.lit(tail_length(cfg)))
    block = F.lit(cfg.hst_window)
    bounds = bounds.withColumn("start", F.col("lo") + F.floor(spare / block) * block)
    return windows.join(bounds, "series")


def _core(windows: DataFrame, cfg: EngineConfig) -> DataFrame:
    rows = _with_bounds(windows.select("series", "window_id", *COUNTS), cfg)
    head = rows.where(F.col("window_id") < F.col("start")).select("*", *derived_columns(cfg))
    # A window of the head that is not there is empty, and its features are zero.
    gap = F.max(F.col("start") - F.col("lo")) > F.count(F.lit(1))
    zero = F.when(gap, F.lit(0.0))
    extremes = head.groupBy(F.col("series").alias("whose")).agg(
        F.array(*[F.least(F.min(F.col(c).cast("double")), zero) for c in FEATURES]).alias("low"),
        F.array(*[F.greatest(F.max(F.col(c).cast("double")), zero) for c in FEATURES]).alias("high"))
    tail = rows.where(F.col("window_id") >= F.col("start"))
    names, column = STATE.fieldNames(), FEATURES.index(cfg.value_metric)

    def settle(key, tail: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        scorer = WindowScorer(cfg)
        scorer.trees = split_table(cfg.hst_trees, cfg.hst_height, cfg.hst_seed)
        first = tail.iloc[0]
        start, hi = int(first["start"]), int(first["hi"])
        s = scorer._start(int(first["lo"]))
        s["last"] = start - 1
        if len(before):
            s["low"], s["high"] = (np.asarray(before.iloc[0][c], dtype=float).tolist() for c in ("low", "high"))
        known = {int(r["window_id"]): r for r in tail.to_dict("records")}
        features = np.array([scorer._features(known.get(w) or scorer._empty(w)) for w in range(start, hi + 1)])
        scorer._trees(s, features)
        values = features[:, column].tolist()
        s["recent"] = values[-cfg.zscore_window:]
        for i, x in enumerate(values):
            _, s["mean"], s["var"] = ewma_step(s["mean"], s["var"], i + 1, x, cfg)
        s["last"] = s["swept"] = hi
        return pd.DataFrame([{"series": key[0], "core": {n: s[n] for n in names}}])

    return tail.groupBy("series").cogroup(extremes.groupBy("whose")).applyInPandas(
        lambda key, t, e: settle(key, t, e) if len(t) else pd.DataFrame(columns=["series", "core"]), CORE)


def _levels(topk: DataFrame, windows: DataFrame, cfg: EngineConfig) -> DataFrame:
    keep = 1.0 - cfg.baseline_alpha
    after = F.lit(keep) * F.col("baseline") + F.lit(cfg.baseline_alpha) * F.col("cnt")
    seen = baselines(topk, cfg).groupBy("series", "dim", "value").agg(
        F.max_by(after, "window_id").alias("level"), F.max("window_id").alias("last"))
    ends = windows.groupBy("series").agg(F.max("window_id").alias("hi"))
    unseen = F.col("hi") - F.col("last")
    forgotten = (unseen > 0) & (F.col("level") * F.pow(F.lit(keep), unseen) < cfg.baseline_prune)
    return seen.join(ends, "series").where(~forgotten).drop("hi")


def scorer_state(windows: DataFrame, topk: DataFrame, cfg: EngineConfig) -> DataFrame:
    """State of every series after its last window of ``windows`` (``window_metrics``), with the
    kept dimension values ``topk`` (``dim_topk``) of the same windows. Cut both at the end of a
    window, and let the stream start there. The state is written once, so that a stream which
    starts again after a failure takes over the same rows."""
    none = lambda t: F.lit(None).cast(t)
    core = _core(windows, cfg).select(
        "series", "core", none("string").alias("dim"), none("string").alias("value"),
        none("double").alias("level"), none("bigint").alias("last"))
    levels = _levels(topk, windows, cfg).select(
        "series", none(STATE).alias("core"), "dim", "value", "level", F.col("last").cast("bigint"))
    return stage(core.unionByName(levels), "scorer-state")
