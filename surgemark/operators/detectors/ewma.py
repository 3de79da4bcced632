"""EWMA control chart as two scaled prefix sums.

With ``b = 1 - alpha`` the recursions ``m' = b m + alpha x`` and
``v' = b (v + alpha d^2)`` unroll to

    m_before(i) = b^(i-1) * sum_{j<i} w_j x_j b^-j      (w_0 = 1, then alpha)
    v_before(i) = b^i     * sum_{0<j<i} alpha d_j^2 b^-j,    d_j = x_j - m_before(j)

so each slice needs only running sums, which Spark evaluates JVM-side over one sort. Row
0 is the first window of the series, or the window ``ewma_halo`` rows before the slice, so
far back that the forgotten past weighs under 1e-50. Earlier rows that other detectors
brought along have no weight, so the exponent never exceeds ``ewma_halo + slice_len``,
which ``EngineConfig`` keeps far inside a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import half_up
from surgemark.operators.detectors.base import (
    Detector, result_struct, row_number_in_series, sigma_verdict, slice_line,
)


class EwmaChart(Detector):
    name = "ewma"

    def history(self, cfg: EngineConfig) -> int:
        return cfg.ewma_halo

    def apply(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        a, b = cfg.ewma_alpha, 1.0 - cfg.ewma_alpha
        line = slice_line()
        before = line.rowsBetween(Window.unboundedPreceding, -1)
        x = F.col(cfg.value_metric).cast("double")
        i = F.col("_ei")
        start = F.greatest(F.col("lo"), F.col("slice") * cfg.slice_len - cfg.ewma_halo)
        frame = (
            frame.withColumn("_ei", F.col("window_id") - start)
            .withColumn("_ew", F.when(i == 0, x).when(i > 0, F.lit(a) * x) * F.pow(F.lit(b), -i))
            .withColumn("_em", F.sum("_ew").over(before) * F.pow(F.lit(b), i - 1))
            .withColumn("_ed", x - F.col("_em"))
            .withColumn("_eq", F.when(
                i > 0, F.lit(a) * F.col("_ed") * F.col("_ed") * F.pow(F.lit(b), -i)))
            .withColumn(
                "_es",
                F.sqrt(F.coalesce(F.sum("_eq").over(before), F.lit(0.0)) * F.pow(F.lit(b), i)),
            )
        )
        first = row_number_in_series() == 0
        warming = first | (row_number_in_series() + 1 <= cfg.ewma_warmup)
        mean, std, flat = F.col("_em"), F.col("_es"), F.col("_e_flat")
        frame = sigma_verdict(
            frame, "_e_", mean, std, x, warming, cfg.ewma_threshold, cfg.direction)
        result = result_struct(
            self.name, F.col("_e_flag"), F.col("_e_score"), x, F.when(first, x).otherwise(mean),
            z=F.when(warming, F.lit(None)).when(flat, F.lit(0.0)).otherwise(half_up(F.col("_e_z"), 3)),
            std=F.when(warming | flat, F.lit(None)).otherwise(half_up(std, 4)),
            mean=F.when(first, F.lit(None)).otherwise(half_up(mean, 4)),
            warmup=F.when(warming, F.lit(True)),
        )
        return frame.withColumn(self.name, result).drop(
            "_ei", "_ew", "_em", "_ed", "_eq", "_es", "_e_flag", "_e_score", "_e_z", "_e_flat")
