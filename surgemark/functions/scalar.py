"""Column expressions shared by the operators; all stay inside JVM codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

GLOBAL_SERIES = "all"


def series_key(series_cols: Sequence[str] = ()) -> Column:
    """One string that names the series a row belongs to.

    No columns means the single global series. Several columns are encoded as a
    JSON object, so different tuples never collide.
    """
    if not series_cols:
        return F.lit(GLOBAL_SERIES)
    if len(series_cols) == 1:
        return F.coalesce(F.col(series_cols[0]).cast("string"), F.lit("?"))
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in series_cols]))


def with_series(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("series", series_key(series_cols))


def epoch(ts: Column) -> Column:
    """Timestamp to float unix seconds, microsecond exact."""
    return F.unix_micros(ts) / F.lit(1_000_000.0)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * F.lit(1_000_000.0)).cast("long"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def half_up(c: Column, digits: int) -> Column:
    """``floor(x*10^d + 0.5) / 10^d``: the same IEEE steps in any engine."""
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def logistic(x: Column) -> Column:
    """Maps R to (0, 1); the exponent is never positive, so nothing overflows."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, F.lit(1.0) / (F.lit(1.0) + e)).otherwise(e / (F.lit(1.0) + e))


def direction_ok(delta: Column, direction: str) -> Column:
    if direction == "up":
        return delta > 0
    if direction == "down":
        return delta < 0
    return F.lit(True)


def clamp01(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))
