"""Rolling z-score: the value against the previous N windows, itself excluded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import half_up
from surgemark.operators.detectors.base import (
    Detector, result_struct, sigma_verdict, slice_line,
)


class RollingZScore(Detector):
    name = "zscore"

    def history(self, cfg: EngineConfig) -> int:
        return cfg.zscore_window

    def apply(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        past = slice_line().rowsBetween(-cfg.zscore_window, -1)
        x = F.col(cfg.value_metric).cast("double")
        n, mean, std, flat = (F.col(c) for c in ("_zn", "_zm", "_zs", "_z_flat"))
        warming = n < cfg.zscore_min_samples
        frame = sigma_verdict(
            frame.withColumns({
                "_zn": F.count(x).over(past), "_zm": F.avg(x).over(past),
                "_zs": F.stddev_samp(x).over(past),
            }),
            "_z_", mean, std, x, warming, cfg.zscore_threshold, cfg.direction,
        )
        result = result_struct(
            self.name, F.col("_z_flag"), F.col("_z_score"), x, F.when(warming, x).otherwise(mean),
            z=F.when(warming | flat, F.lit(0.0)).otherwise(half_up(F.col("_z_z"), 3)),
            std=F.when(warming, F.lit(None)).when(flat, F.lit(0.0)).otherwise(half_up(std, 4)),
            mean=F.when(warming, F.lit(None)).when(flat, mean).otherwise(half_up(mean, 4)),
            samples=F.when(warming, n),
            warmup=F.when(warming, F.lit(True)),
        )
        return frame.withColumn(self.name, result).drop(
            "_zn", "_zm", "_zs", "_z_flag", "_z_score", "_z_z", "_z_flat")
