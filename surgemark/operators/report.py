"""Readable anomaly report and headline tiles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.functions.text_format import (
    age, clock, compact, dim_label, fixed, integer, pct, severity_label,
)

FACTOR_SHOWN_ABOVE = 1.2
WHY_SHOWN = 4


def anomaly_report(anomalies: DataFrame, now: Column | None = None) -> DataFrame:
    """One text-ready row per anomaly."""
    factor = F.when(F.col("expected") > 0, F.col("value") / F.col("expected")).otherwise(F.lit(0.0))
    shown = F.when(F.col("_factor") >= 10, compact(F.col("_factor"))).otherwise(fixed(F.col("_factor"), 1))
    fired = F.filter("detectors", lambda d: d["flag"])
    live = F.filter("detectors", lambda d: ~F.coalesce(d["detail"]["unavailable"], F.lit(False)))
    out = anomalies.withColumn("_factor", factor)
    columns = [
        "id", "series", "ts",
        severity_label(F.col("severity")).alias("label"),
        F.concat(F.col("metric"), F.lit(" spike")).alias("title"),
        compact(F.col("value")).alias("observed"),
        compact(F.col("expected")).alias("expected"),
        F.when(F.col("_factor") > FACTOR_SHOWN_ABOVE, F.concat(shown, F.lit("×"))).alias("factor"),
        pct(F.col("score")).alias("confidence"),
        F.concat(F.col("agreement").cast("string"), F.lit("/"), F.size(live).cast("string"),
                 F.lit(" agree")).alias("agree"),
        F.transform(fired, lambda d: F.concat(
            d["name"],
            F.coalesce(F.concat(F.lit(" z"), fixed(d["detail"]["z"], 1)), F.lit("")),
        )).alias("fired"),
        clock(F.col("ts")).alias("clock"),
    ]
    if "why" in anomalies.columns:
        columns.append(F.transform(F.slice("why", 1, WHY_SHOWN), lambda c: F.struct(
            F.concat(dim_label(c["dim"]), F.lit(": "), c["value"]).alias("label"),
            F.least(F.lit(100.0), c["share"] * 100).alias("width_pct"),
            F.concat(F.lit("+"), compact(c["excess"])).alias("excess"),
        )).alias("why"))
    if now is not None:
        columns.append(age(F.col("ts"), now).alias("age"))
    return out.select(*columns)


def tiles(windows: DataFrame) -> DataFrame:
    """Headline values of the newest window of each series."""
    newest = windows.groupBy("series").agg(F.max_by(
        F.struct("rate", "distinct_subjects", "distinct_actors", "bot_ratio"), "window_id"
    ).alias("w"))
    return newest.select(
        "series",
        compact(F.col("w.rate")).alias("events_per_sec"),
        integer(F.col("w.distinct_subjects")).alias("active_subjects"),
        integer(F.col("w.distinct_actors")).alias("active_actors"),
        pct(F.col("w.bot_ratio")).alias("bot_share"),
    )
