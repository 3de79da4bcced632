"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) pick data and cores.
With BENCH_EVENTS=n the events table is laid over itself, a second later each time, until one
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

HEADLINE = (
    "normalise_events", "window_metrics", "window_metrics_gapfilled", "fold_late_windows",
    "dim_topk", "zscore", "ewma", "hst", "baseline", "anomalies", "anomalies_explained",
    "anomalies_three_detectors", "incident_window", "recentchange_normalise", "stale_intervals",
    "orders_windows", "bm25", "keyword_category",
)


def session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("surgemark")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def long_series(spark: SparkSession, sf: str, n: int) -> dict[str, float]:
    """Seconds for one global series of ``n`` events in one-second windows."""
    from pyspark.sql import functions as F

    from surgemark.config import EngineConfig
    from surgemark.operators import windows as win
    from surgemark.plans.detection import detect_anomalies, score_windows
    from surgemark.plans.staging import stage
    from surgemark.sources.tables import normalise_events

    raw = spark.read.parquet(f"{sf}/events.parquet")
    rows = raw.count()
    copies = spark.range(-(-n // rows)).withColumnRenamed("id", "copy")
    laid = raw.join(copies).select(
        (F.col("event_id") + F.col("copy") * rows).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("copy").cast("decimal(18,6)"))).alias("ts"),
        *[c for c in raw.columns if c not in ("event_id", "ts")])
    events = normalise_events(stage(laid, "bench-events"))
    cfg = EngineConfig(tick_seconds=1.0, cooldown_seconds=4.0)
    stored = stage(win.window_metrics(events, cfg), "bench-windows")
    plans = {
        "long_window_metrics": lambda: win.window_metrics(events, cfg),
        "long_gap_filling": lambda: win.fill_gaps(stored, cfg),
        **{f"long_{d}": lambda d=d: score_windows(stored, cfg.with_(detectors=(d,))) for d in cfg.detectors},
        "long_detection": lambda: detect_anomalies(events, cfg).anomalies,
    }
    return {name: timed(plan) for name, plan in plans.items()}


def timed(plan) -> float:
    start = time.perf_counter()
    plan().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    from checks.queries import QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.read.parquet(f"{sf}/events.parquet").count()
    if os.environ.get("BENCH_EVENTS"):
        times = long_series(spark, sf, int(os.environ["BENCH_EVENTS"]))
    else:
        times = {name: timed(lambda name=name: QUERIES[name](spark, sf)) for name in HEADLINE}
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
