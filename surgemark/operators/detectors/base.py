"""What a detector is: columns over dense, sliced window rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import clamp01, direction_ok, logistic
from surgemark.schemas import DETAIL

FLAT_STD = 1e-9
ROUNDING = 1e-12        # relative difference below which two doubles count as equal
FLAT_SCORE = 0.6


class Detector:
    """Base class. ``frame`` rows are gap-filled windows of one slice plus its halo
    (see ``dense_slices``); results need only be right where ``in_slice`` holds."""

    name = "base"

    def history(self, cfg: EngineConfig) -> int:
        """Windows of history a row needs; slices repeat at least this many."""
        return 0

    def prepare(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        """Optional pass that adds plain columns (for work outside the JVM)."""
        return frame

    def apply(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        """Add a result struct column called ``self.name``."""
        raise NotImplementedError


def slice_line() -> WindowSpec:
    return Window.partitionBy("series", "slice").orderBy("window_id")


def row_number_in_series() -> Column:
    """0-based position of a window in its gap-free series."""
    return F.col("window_id") - F.col("lo")


def result_struct(
    name: str, flag: Column, score: Column, value: Column, expected: Column, **detail: Column
) -> Column:
    parts = [
        detail.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DETAIL.fields
    ]
    return F.struct(
        F.lit(name).alias("name"), F.coalesce(flag, F.lit(False)).alias("flag"),
        clamp01(score).alias("score"), value.cast("double").alias("value"),
        expected.cast("double").alias("expected"), F.struct(*parts).alias("detail"),
    )


def unavailable_struct(name: str, value: Column) -> Column:
    return result_struct(
        name, F.lit(False), F.lit(0.0), value, value, unavailable=F.lit(True)
    )


def departure(x: Column, mean: Column) -> Column:
    """``x - mean``, where a mere rounding difference is no move in either direction (the
    sign of such a difference would depend on the order values were summed in)."""
    return F.when(F.abs(x - mean) <= F.abs(x) * ROUNDING, F.lit(0.0)).otherwise(x - mean)


def sigma_verdict(
    frame: DataFrame, prefix: str, mean: Column, std: Column, x: Column, warming: Column,
    threshold: float, direction: str,
) -> DataFrame:
    """Add ``<prefix>flag``, ``score``, ``z`` and ``flat``: shared by the scalar detectors.

    A flat history cannot scale a departure, so any departure in the watched direction
    gets a fixed score and a reported z of 0. Otherwise the score is a logistic centred
    on the threshold, given to every move in the watched direction, flagged or not.
    Intermediate columns keep each term computed once.
    """
    delta, z, flat, ok, hit = (F.col(f"{prefix}{n}") for n in ("delta", "z", "flat", "ok", "hit"))
    return (
        frame.withColumn(f"{prefix}delta", departure(x, mean))
        .withColumns({
            f"{prefix}flat": std < FLAT_STD,
            f"{prefix}z": F.when(std >= FLAT_STD, F.col(f"{prefix}delta") / std),
            f"{prefix}ok": direction_ok(delta, direction),
        })
        .withColumns({
            f"{prefix}hit": (F.abs(delta) > FLAT_STD) & ok,
            f"{prefix}steep": logistic(F.abs(z) - F.lit(threshold)),
        })
        .withColumns({
            f"{prefix}flag": F.coalesce(
                ~warming & F.when(flat, hit).otherwise(ok & (F.abs(z) >= threshold)), F.lit(False)),
            f"{prefix}score": F.when(warming, F.lit(0.0))
            .when(flat, F.when(hit, F.lit(FLAT_SCORE)).otherwise(F.lit(0.0)))
            .when(ok, F.col(f"{prefix}steep")).otherwise(F.lit(0.0)),
        })
        .drop(*[f"{prefix}{n}" for n in ("delta", "ok", "hit", "steep")])
    )
