"""Pipeline-health rollups: rates, trailing counts, lag bands, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.operators.prefix import slice_rows

TRAILING_SECONDS, PANE_SECONDS = 300, 5
LAG_YELLOW, LAG_RED = 2.0, 5.0
SLICE_SECONDS = 86_400


def minute_of(seconds: Column) -> Column:
    return (F.floor(seconds / 60) * 60).cast("long")


def latest_rate(windows: DataFrame) -> DataFrame:
    return windows.groupBy("series").agg(F.max_by("rate", "window_id").alias("latest_rate"))


def trailing_count(
    rows: DataFrame, at: Column, span: int = TRAILING_SECONDS, length: int = SLICE_SECONDS,
    weight: Column | None = None,
) -> DataFrame:
    """Rows, or the sum of ``weight`` over them, in the ``span`` seconds up to each active
    second (both ends included).

    Rows combine to counts per second first; day slices with a ``span`` halo then carry
    the range frame, so neither a hot second nor a long series meets one task.
    """
    seconds = (
        rows.withColumn("second", F.floor(at).cast("long"))
        .groupBy("series", "second").agg(F.sum(F.lit(1) if weight is None else weight).cast("long").alias("n"))
    )
    frame = Window.partitionBy("series", "slice").orderBy("second").rangeBetween(-span, 0)
    return (
        slice_rows(seconds, span, length, key="second")
        .withColumn("trailing", F.sum("n").over(frame))
        .where("in_slice")
        .select("series", "second", "n", "trailing")
    )


def trailing_panes(
    rows: DataFrame, ts: str = "ts", span: int = TRAILING_SECONDS, step: int = PANE_SECONDS,
    weight: Column | None = None,
) -> DataFrame:
    """Rows, or the sum of ``weight`` over them, in the ``span`` seconds up to every ``step``
    seconds (the end itself left out), for tables and for streams with a watermark on ``ts``.

    Rows combine to panes of one step first, and only these pane counts, one a series and
    step, reach the ``span / step`` windows that share them. Windows without a row are left out.
    """
    if span % step:
        raise ValueError("span must be a multiple of step")
    one = F.lit(1) if weight is None else weight
    panes = rows.groupBy("series", F.window(ts, f"{step} seconds").alias("pane")).agg(
        F.sum(one).cast("long").alias("n"))
    return (
        panes.groupBy("series", F.window(F.window_time("pane"), f"{span} seconds", f"{step} seconds").alias("w"))
        .agg(F.sum("n").cast("long").alias("trailing"))
        .select("series", F.col("w.end").alias("until"), "trailing")
    )


def processing_lag(windows: DataFrame, processed_at: Column) -> DataFrame:
    """Seconds between a window's end and its processing, with the dashboard bands."""
    return (
        windows.withColumn("lag", F.greatest(F.lit(0.0), processed_at - F.col("window_end")))
        .withColumn(
            "band",
            F.when(F.col("lag") >= LAG_RED, "red").when(F.col("lag") >= LAG_YELLOW, "yellow")
            .otherwise("green"),
        )
        .select("series", "window_id", "lag", "band")
    )


def throughput(ingested: DataFrame, processed: DataFrame, at: Column) -> DataFrame:
    """Events per second ingested and processed, by minute."""
    def per_minute(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("series", minute_of(at).alias("minute")).agg(
            (F.count(F.lit(1)) / F.lit(60.0)).alias(name)
        )

    return (
        per_minute(ingested, "ingested_per_sec")
        .join(per_minute(processed, "processed_per_sec"), on=["series", "minute"], how="full_outer")
        .na.fill(0.0, ["ingested_per_sec", "processed_per_sec"])
    )


def anomalies_by_severity(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(minute_of(F.col("ts")).alias("minute"), "severity").agg(
        F.count(F.lit(1)).alias("n")
    )


def fires_by_detector(results: DataFrame) -> DataFrame:
    """Flags per minute and detector, minutes without a flag left out."""
    return (
        results.where("flag")
        .groupBy(minute_of(F.col("ts")).alias("minute"), "name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def duration_p95(durations: DataFrame, at: Column, seconds: str = "seconds") -> DataFrame:
    """95th percentile of processing time per 5 minutes (mergeable sketch)."""
    return durations.groupBy((F.floor(at / 300) * 300).cast("long").alias("period")).agg(
        F.percentile_approx(seconds, 0.95, 10_000).alias("p95"),
        F.count(F.lit(1)).alias("batches"),
    )
