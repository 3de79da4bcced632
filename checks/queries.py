"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

All queries read whole tables. Time series use 600 s windows over one global series, or
3600 s windows per event type; cooldowns are four windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import epoch, half_up, with_series
from surgemark.operators import detectors, frames, health, history, ingest, report, series, text, windows as win
from surgemark.operators.ensemble import anomaly_records, apply_cooldown, ensemble
from surgemark.operators.explain import baselines
from surgemark.plans.detection import (
    Detection, detect_anomalies, explode_results, score_windows, surfaced_windows, why_for,
)
from surgemark.plans.staging import stage, stage_path, stage_root
from surgemark.sources import capture, jsonl, recentchange, registry, tables
from surgemark.streaming import closing, handover, run, scoring

Query = Callable[[SparkSession, str], DataFrame]

TWO = EngineConfig(tick_seconds=600, cooldown_seconds=2400, detectors=("zscore", "ewma"))
THREE = TWO.with_(detectors=("zscore", "ewma", "hst"))
HOURLY = EngineConfig(tick_seconds=3600, cooldown_seconds=14_400, detectors=("zscore", "ewma"))
BY_TYPE = ("event_type",)
FLUSH_TO = 1_706_749_200.0      # 2024-02-01 01:00 UTC
FEED_TICK = 150.0               # a silence over 600 s counts as stale
QUIET_FROM = 1_704_672_000.0    # 2024-01-08 00:00 UTC
INGEST_TIME = 1_700_000_000.0
FILE_ROWS = 250_000                # events in a file of a made micro-batch, about


def events(spark: SparkSession, sf: str) -> DataFrame:
    return tables.normalise_events(spark.read.parquet(f"{sf}/events.parquet"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return tables.normalise_orders(spark.read.parquet(f"{sf}/orders.parquet"))


def flat_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.unix_micros("ts").alias("ts_us"), "source", "id", "kind", "actor", "subject", "bot",
        "bytes_delta", "weight",
        *[F.col("dims")[d].alias(d) for d in ("domain", "lang", "namespace", "user_type")],
    )


def window_view(w: DataFrame) -> DataFrame:
    return w.select(
        "series", "window_id", "window_start", "window_end", "count", "distinct_subjects",
        "distinct_actors", "bot_count", "new_count", "bytes_changed", "rate",
        half_up(F.col("bot_ratio"), 6).alias("bot_ratio"),
        half_up(F.col("bytes_per_sec"), 6).alias("bytes_per_sec"),
        half_up(F.col("new_rate"), 9).alias("new_rate"),
    )


# -- sources -----------------------------------------------------------------------


def normalise_events(spark, sf):
    return flat_events(events(spark, sf))


def normalise_orders(spark, sf):
    return orders(spark, sf).select(
        F.unix_micros("ts").alias("ts_us"), "source", "id", "kind", "actor", "subject", "bot",
        "bytes_delta", "weight", F.col("dims")["domain"].alias("domain"))


def change_payloads(spark, sf) -> DataFrame:
    """Recent-change JSON derived from the events table, with every irregular shape."""
    e, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("long")
    def part(cond, value):
        return F.when(cond, value).otherwise(F.lit(None))
    def quoted(name, c):
        return F.concat(F.lit(f'"{name}":"'), c.cast("string"), F.lit('"'))
    def plain(name, c):
        return F.concat(F.lit(f'"{name}":'), c.cast("string"))
    meta = F.concat(F.lit('"meta":{'), F.concat_ws(
        ",", part(e % 7 != 0, quoted("id", F.concat(F.lit("m"), e.cast("string")))),
        quoted("domain", F.concat(F.lit("d"), (k % 10).cast("string"), F.lit(".example.org"))),
    ), F.lit("}"))
    size = F.concat(F.lit('"length":{'), F.concat_ws(
        ",", plain("old", F.when(e % 2 == 0, "null").otherwise(k.cast("string"))),
        plain("new", F.col("value")),
    ), F.lit("}"))
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    body = F.concat(F.lit("{"), F.concat_ws(
        ",", meta,
        quoted("server_name", F.when(e % 3 == 0, "").otherwise(
            F.concat(F.lit("s"), (k % 10).cast("string"), F.lit(".example.org")))),
        part(e % 5 != 0, quoted("type", F.col("event_type"))),
        quoted("user", F.when(e % 11 == 0, "").otherwise(F.col("user_id").cast("string"))),
        quoted("title", F.concat(F.lit("t"), k.cast("string"))),
        plain("bot", F.when(F.col("user_id") % 5 == 0, "true").otherwise("false")),
        F.when(e % 17 == 0, F.lit('"timestamp":"oops"')).otherwise(plain("timestamp", seconds)),
        part(e % 23 != 0, plain("namespace", F.when(e % 19 == 0, "null").otherwise(
            (k % 4).cast("string")))),
        part(e % 29 != 0, size),
    ), F.lit("}"))
    return spark.read.parquet(f"{sf}/events.parquet").select(
        e.alias("seq"),
        F.when(e % 13 == 0, "oops").when(e % 13 == 1, "[1]").otherwise(body).alias("value"),
    )


def recentchange_normalise(spark, sf):
    ev = recentchange.normalise_recentchange(
        change_payloads(spark, sf), ingest_time=F.lit(INGEST_TIME), seq=F.col("seq"))
    return flat_events(ev)


def sse_capture(spark, sf):
    """Events written as event-stream captures, then read back frame by frame."""
    e = F.col("event_id")
    frame = F.concat(
        F.when(e % 4 == 0, F.lit(": keep-alive\n")).otherwise(F.lit("")),
        F.when(e % 3 != 0, F.concat(F.lit("id: "), e.cast("string"), F.lit("\n"))).otherwise(F.lit("")),
        F.when(e % 10 == 9, F.lit("event: ping\n")).otherwise(F.concat(
            F.lit("data: "), e.cast("string"), F.lit("\ndata:"), F.col("event_type"), F.lit("\n"))),
    )
    path = f"{stage_root(spark)}/capture-{uuid.uuid4().hex}"
    (
        spark.read.parquet(f"{sf}/events.parquet")
        .select(F.floor(e / 2000).alias("part"), e, frame.alias("value"))
        .repartition("part").sortWithinPartitions("part", "event_id")
        .select("part", "value")
        .write.partitionBy("part").text(path)
    )
    return capture.read_capture(spark, path).select("event_id", "data")


def jsonl_replay(spark, sf):
    """Record, read back, normalised columns unchanged."""
    path = f"{stage_root(spark)}/recording-{uuid.uuid4().hex}"
    jsonl.record_events(events(spark, sf), path)
    return flat_events(jsonl.read_recording(spark, path))


def source_registry(spark, sf):
    """Every table and recording read through the registry, by name."""
    recording = stage_path(spark, "recording")
    jsonl.record_events(events(spark, sf), recording)
    places = {"events": f"{sf}/events.parquet", "orders": f"{sf}/orders.parquet", "jsonl": recording}
    out = None
    for name, place in places.items():
        rows = registry.read_events(spark, name, place).groupBy().agg(
            F.count(F.lit(1)).alias("n"), F.sum("bytes_delta").alias("bytes"), F.count_if("bot").alias("bots"),
            F.min(F.unix_micros("ts")).alias("first_us")).select(F.lit(name).alias("name"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def registered_changes(spark, sf):
    """Payloads as lines of text and as captured frames, both read through the registry, by name."""
    lines, frames = stage_path(spark, "payloads"), stage_path(spark, "frames")
    payloads = change_payloads(spark, sf).select("value")
    payloads.write.text(lines)
    payloads.select(F.concat(F.lit("data: "), "value", F.lit("\n"))).write.text(frames)
    out = None
    for name, place in {"recentchange": lines, "capture": frames}.items():
        rows = registry.read_events(spark, name, place).groupBy("kind", F.col("dims")["namespace"].alias("namespace")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("bytes_delta").alias("bytes"), F.count_if("bot").alias("bots"),
            F.countDistinct("subject").alias("subjects")).select(F.lit(name).alias("name"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def dedupe(spark, sf):
    ev = events(spark, sf)
    doubled = ev.unionByName(ev.where("bot"))
    return ingest.dedupe(doubled).select("source", "id", "kind", "bytes_delta")


def rate_cap(spark, sf):
    cfg = EngineConfig(max_events_per_sec=3)
    arrival = F.floor(F.col("seq") / 5)
    return ingest.rate_cap(events(spark, sf), cfg, arrival).select("seq", "kind")


def rate_drops(spark, sf):
    cfg = EngineConfig(max_events_per_sec=3)
    return ingest.rate_drops(events(spark, sf), cfg, F.floor(F.col("seq") / 5))


def retime(spark, sf):
    moved = ingest.retime(events(spark, sf), start=1_800_000_000.0, speed=4.0)
    return moved.select("seq", half_up(epoch(F.col("ts")), 3).alias("t"))


def replay_gaps(spark, sf):
    return ingest.replay_gaps(events(spark, sf), speed=100.0, chunk_rows=3_000).select(
        "seq", half_up(F.col("gap"), 6).alias("gap"))


# -- windows -----------------------------------------------------------------------


def window_metrics(spark, sf):
    return window_view(win.window_metrics(events(spark, sf), TWO))


def window_metrics_by_type(spark, sf):
    return window_view(win.window_metrics(events(spark, sf), HOURLY, BY_TYPE))


def orders_windows(spark, sf):
    cfg = EngineConfig(tick_seconds=86_400)
    return window_view(win.window_metrics(orders(spark, sf), cfg))


def window_metrics_gapfilled(spark, sf):
    return window_view(win.fill_gaps(win.window_metrics(events(spark, sf), TWO), TWO))


def flush_windows(spark, sf):
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    return window_view(win.fill_gaps(w, HOURLY, flush_to=FLUSH_TO))


def fold_late_windows(spark, sf):
    e = F.col("event_id")
    late = events(spark, sf).withColumn("event_id", F.col("seq")).withColumn(
        "seq", e + 37 * (e % 11))
    return window_view(win.window_metrics(late, TWO.with_(late="fold")))


def feature_vector(spark, sf):
    w = win.window_metrics(events(spark, sf), TWO)
    return w.select("window_id", F.explode(win.feature_map()).alias("name", "v")).select(
        "window_id", "name", half_up(F.col("v"), 6).alias("v"))


def dim_counts(spark, sf):
    return win.dim_counts(events(spark, sf), HOURLY).select("series", "window_id", "dim", "value", "cnt")


def dim_topk(spark, sf):
    cfg = HOURLY.with_(dim_topk=3)
    return win.dim_topk(win.dim_counts(events(spark, sf), cfg), cfg)


# -- detectors -----------------------------------------------------------------------


def scored(spark, sf, cfg=TWO, series_cols=()):
    """Scored windows over stored window rows, as the detection plan runs them."""
    w = stage(win.window_metrics(events(spark, sf), cfg, series_cols), "windows")
    return score_windows(w, cfg)


def result_view(s: DataFrame, name: str) -> DataFrame:
    r = explode_results(s).where(F.col("name") == name)
    return r.select(
        "series", "window_id", "flag", half_up(F.col("score"), 6).alias("score"),
        half_up(F.col("value"), 9).alias("value"), half_up(F.col("expected"), 9).alias("expected"),
        F.coalesce(F.col("detail.warmup"), F.lit(False)).alias("warmup"),
    )


def zscore(spark, sf):
    return result_view(scored(spark, sf, TWO.with_(detectors=("zscore",))), "zscore")


def zscore_both(spark, sf):
    cfg = HOURLY.with_(detectors=("zscore",), direction="both", primary_metric="bytes_per_sec")
    return result_view(scored(spark, sf, cfg, BY_TYPE), "zscore")


def ewma(spark, sf):
    return result_view(scored(spark, sf, TWO.with_(detectors=("ewma",))), "ewma")


def ewma_fast(spark, sf):
    return result_view(scored(spark, sf, TWO.with_(detectors=("ewma",), ewma_alpha=0.96)), "ewma")


def ewma_long_history(spark, sf):
    """Another detector's window is far longer than what EWMA can weigh."""
    cfg = TWO.with_(tick_seconds=300, detectors=("ewma",), zscore_window=9000)
    return result_view(scored(spark, sf, cfg), "ewma")


class Ceiling(detectors.Detector):
    """A detector of the user's own: a fixed upper bound."""

    name = "ceiling"
    most = 18

    def apply(self, frame, cfg):
        over = F.col("count") > self.most
        return frame.withColumn(self.name, detectors.result_struct(
            self.name, over, F.when(over, F.lit(1.0)).otherwise(0.0), F.col("count"), F.lit(float(self.most))))


def registered_detector(spark, sf):
    """A fourth detector, registered by name, beside a built-in one."""
    detectors.register(Ceiling())
    s = scored(spark, sf, TWO.with_(detectors=("zscore", "ceiling")))
    return explode_results(s).where("name = 'ceiling'").select(
        "series", "window_id", "flag", "score", "value", "expected")


def ewma_down(spark, sf):
    cfg = HOURLY.with_(detectors=("ewma",), direction="down")
    return result_view(scored(spark, sf, cfg, BY_TYPE), "ewma")


def hst(spark, sf):
    s = scored(spark, sf, HOURLY.with_(detectors=("hst",)))
    return explode_results(s).select(
        "series", "window_id", "flag", half_up(F.col("score"), 6).alias("score"),
        half_up(F.col("value"), 9).alias("value"))


def detector_results(spark, sf):
    """Long results of two live detectors and one marked unavailable."""
    cfg = HOURLY.with_(detectors=("zscore", "ewma", "hst"), unavailable=("hst",))
    return explode_results(scored(spark, sf, cfg, BY_TYPE)).select(
        "series", "window_id", "name", "flag", half_up(F.col("score"), 6).alias("score"),
        F.coalesce(F.col("detail.unavailable"), F.lit(False)).alias("unavailable"))


# -- ensemble and explanation -----------------------------------------------------------


def candidate_view(c: DataFrame) -> DataFrame:
    return c.select(
        "series", "window_id", "window_end", "agreement", "severity", "score",
        half_up(F.col("value"), 9).alias("value"), half_up(F.col("expected"), 9).alias("expected"),
    )


def ensemble_candidates(spark, sf):
    return candidate_view(ensemble(scored(spark, sf), TWO))


def cooldown(spark, sf):
    """Emitted candidates with a long cooldown, decided across many small chunks."""
    cfg = HOURLY.with_(cooldown_seconds=90_000.0, zscore_threshold=1.5, ewma_threshold=1.5)
    c = stage(ensemble(scored(spark, sf, cfg, BY_TYPE), cfg), "candidates")
    return candidate_view(apply_cooldown(c, cfg, chunk_spans=2))


def anomalies(spark, sf):
    a = surfaced_windows(scored(spark, sf), TWO, staged=True)
    return candidate_view(a).join(a.select("series", "window_id", "id", "ts"), ["series", "window_id"])


def anomalies_three_detectors(spark, sf):
    d = detect_anomalies(events(spark, sf), THREE)
    return d.anomalies.select(
        "id", "ts", "series", "metric", "severity", "score", "agreement",
        F.size("detectors").alias("n_detectors"), F.size("why").alias("n_why"))


def baseline(spark, sf):
    cfg = HOURLY
    topk = win.dim_topk(win.dim_counts(events(spark, sf), cfg, BY_TYPE), cfg)
    return baselines(topk, cfg).select(
        "series", "window_id", "dim", "value", "cnt", half_up(F.col("baseline"), 6).alias("baseline"))


def surfaced_by_type(spark, sf):
    return stage(surfaced_windows(scored(spark, sf, HOURLY, BY_TYPE), HOURLY, staged=True), "surfaced")


def why(spark, sf):
    return why_for(surfaced_by_type(spark, sf), events(spark, sf), HOURLY, BY_TYPE, prune=True)


def anomalies_explained(spark, sf):
    """The whole detection plan, per event type; the flagship query."""
    d = detect_anomalies(events(spark, sf), HOURLY, BY_TYPE)
    top = F.get("why", 0)
    return d.anomalies.select(
        "id", "series", "window_id", "ts", "metric", "severity", "score", "agreement",
        half_up(F.col("value"), 9).alias("value"), half_up(F.col("expected"), 9).alias("expected"),
        F.size("why").alias("n_why"), top["dim"].alias("top_dim"), top["value"].alias("top_value"),
        top["excess"].alias("top_excess"), top["share"].alias("top_share"),
    )


# -- history ---------------------------------------------------------------------------


def incident_window(spark, sf):
    cfg = TWO.with_(incident_pad=3600.0)
    stored = stage(win.window_metrics(events(spark, sf), TWO), "windows")
    a = stage(surfaced_windows(score_windows(stored, TWO), TWO, staged=True), "surfaced")
    w = win.fill_gaps(stored, TWO)
    return history.incidents(a, w, cfg).select("anomaly_id", "anomaly_ts", "window_id", "count", "rate")


def recent_metrics(spark, sf):
    w = win.fill_gaps(win.window_metrics(events(spark, sf), TWO), TWO)
    return history.recent_metrics(w, TWO, 86_400).select("window_id", "window_end", "count", "rate")


def recent_metrics_as_of(spark, sf):
    w = win.fill_gaps(win.window_metrics(events(spark, sf), TWO), TWO)
    return history.recent_metrics(w, TWO, 7200, as_of=1_705_000_200.0).select(
        "window_id", "window_end", "count", "rate")


def recent_anomalies(spark, sf):
    a = surfaced_by_type(spark, sf)
    return history.recent_anomalies(a, 10).select("id", "ts", "series", "severity", "score")


def anomaly_listing(spark, sf):
    a = surfaced_by_type(spark, sf)
    return history.list_anomalies(a, HOURLY, 1_000).select("id", "ts", "series", "severity")


def last_windows(spark, sf):
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    return history.last_n(w, 20).select("series", "window_id", "count")


def snapshot(spark, sf):
    s = scored(spark, sf, HOURLY, BY_TYPE)
    found = stage(surfaced_windows(s, HOURLY, staged=True), "surfaced")
    shot = history.snapshot(s.drop("metric", "fired"), found, HOURLY)
    return shot.select(
        F.size("metrics").alias("n_metrics"), F.size("anomalies").alias("n_anomalies"),
        F.element_at("metrics", -1)["window_end"].alias("last_end"), "tick_seconds")


def retention(spark, sf):
    w = win.window_metrics(events(spark, sf), TWO)
    path = stage_path(spark, "metrics")
    history.append_by_day(history.metric_table(w.withColumn("detectors", F.lit(None))), path)
    return history.retain(spark.read.parquet(path), TWO).select(
        F.unix_micros("time").alias("t_us"), "series", "count", half_up(F.col("rate"), 9).alias("rate"))


def expired_days(spark, sf):
    """What a stored metric table holds after its expired days were deleted."""
    w = win.window_metrics(events(spark, sf), TWO)
    path = stage_path(spark, "metrics")
    history.append_by_day(history.metric_table(w.withColumn("detectors", F.lit(None))), path)
    newest = history.read_metrics(spark, path).agg(F.max("day")).first()[0]
    if newest is not None:
        history.drop_expired_days(spark, path, TWO, newest)
    return history.read_metrics(spark, path).select("series", "window_end", "count")


def stored_tables(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Metrics (kept for the retention time) and anomalies, written as the sinks do and read
    back; the anomalies are written twice."""
    windows = stage(win.window_metrics(events(spark, sf), TWO), "windows")
    s = score_windows(windows, TWO)
    found = stage(surfaced_windows(s, TWO, staged=True), "surfaced").withColumn(
        "why", F.array().cast("array<struct<dim:string,value:string,observed:bigint,baseline:double,"
                              "excess:double,share:double>>"))
    nested = win.nest_dims(win.dim_topk(win.dim_counts(events(spark, sf), TWO), TWO))
    root = stage_path(spark, "tables")
    history.append_by_day(history.retain(history.metric_table(s, nested_dims=nested), TWO), f"{root}/metrics")
    for _ in range(2):
        history.append_idempotent(history.anomaly_table(found), f"{root}/anomalies")
    return history.read_metrics(spark, f"{root}/metrics"), history.read_anomalies(spark, f"{root}/anomalies")


def stored_recent_metrics(spark, sf):
    m, _ = stored_tables(spark, sf)
    return history.recent_metrics(m, TWO, 86_400).select(
        "window_end", "count", "rate", F.get(F.col("top")["domain"], 0)["value"].alias("top_domain"),
        F.get(F.col("top")["domain"], 0)["cnt"].alias("top_cnt"))


def stored_incident(spark, sf):
    """Anomalies with the metrics around them; the older ones have none left."""
    m, a = stored_tables(spark, sf)
    return history.incidents(a, m, TWO.with_(incident_pad=3600.0), record=("severity",)).select(
        "anomaly_id", "anomaly_ts", "anomaly_severity", "window_end", "count")


def stored_incident_one(spark, sf):
    """One anomaly by its id, with the stored metrics around it."""
    m, a = stored_tables(spark, sf)
    chosen = a.agg(F.max("id")).first()[0]
    return history.incident(chosen, a, m, TWO.with_(incident_pad=3600.0)).select(
        "anomaly_id", "anomaly_ts", "anomaly_severity", "window_end", "count")


def stored_snapshot(spark, sf):
    """Every row of both lists that a new client gets, from the stored tables."""
    shot = history.snapshot(*stored_tables(spark, sf), TWO)
    m = shot.select(F.lit("metric").alias("kind"), F.posexplode("metrics").alias("pos", "x")).select(
        "kind", "pos", F.col("x.window_end").alias("t"), F.col("x.count").alias("count"), F.lit(None).cast("string").alias("id"))
    a = shot.select(F.lit("anomaly").alias("kind"), F.posexplode("anomalies").alias("pos", "x")).select(
        "kind", "pos", F.col("x.ts").alias("t"), F.lit(None).cast("long").alias("count"), F.col("x.id").alias("id"))
    return m.unionByName(a)


def append_idempotent(spark, sf):
    """The anomaly table after the same batch came twice."""
    _, a = stored_tables(spark, sf)
    return a.select("id", "ts", "series", "severity", "agreement")


def idempotent_append(spark, sf):
    """Insert per-type windows in two overlapping batches; keys are stored once."""
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    first = w.where("window_id % 3 <> 0")
    again = w.where("window_id % 3 <> 1")
    return first.unionByName(history.new_rows(again, first, ["series", "window_id"])).select(
        "series", "window_id", "count")


def pipeline_stats(spark, sf):
    s = scored(spark, sf)
    a = surfaced_windows(s, TWO, staged=True)
    return history.pipeline_stats(events(spark, sf), s, a, TWO).select(
        "events_seen", "snapshots", "anomalies", "last_rate", F.size("detectors").alias("detectors"))


# -- derived series ------------------------------------------------------------------------


def trend(spark, sf):
    w = win.fill_gaps(win.window_metrics(events(spark, sf), HOURLY, BY_TYPE), HOURLY)
    return series.trend(w, "count", length=200).select(
        "series", "window_id", half_up(F.col("trend"), 6).alias("trend"), "direction")


def agreement(spark, sf):
    return series.agreement(scored(spark, sf, HOURLY, BY_TYPE))


def detector_scores(spark, sf):
    s = series.detector_scores(scored(spark, sf, HOURLY, BY_TYPE), ("zscore", "ewma"))
    return s.select("series", "window_id", *[half_up(F.col(c), 6).alias(c) for c in ("zscore", "ewma")])


def sparkline(spark, sf):
    w = win.fill_gaps(win.window_metrics(events(spark, sf), HOURLY, BY_TYPE), HOURLY)
    return series.sparkline(w, "count").select(
        "series", "window_id", half_up(F.col("x"), 6).alias("x"), half_up(F.col("y"), 6).alias("y"))


def series_summary(spark, sf):
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    return series.series_summary(w, 86_400.0).select(
        "series", half_up(F.col("peak_rate"), 9).alias("peak_rate"), "total_events", "x_min", "x_max",
        half_up(F.col("y_max"), 6).alias("y_max"))


def chart_markers(spark, sf):
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    return series.chart_markers(surfaced_by_type(spark, sf), w, 15 * 86_400.0).select("id", "series", "ts")


def stale_intervals(spark, sf):
    cfg = EngineConfig(tick_seconds=FEED_TICK)
    feed = with_series(events(spark, sf), BY_TYPE)
    out = series.stale_intervals(feed, cfg, chunk=100)
    return out.select("series", *[half_up(F.col(c), 3).alias(c) for c in
                                  ("silent_from", "silent_to", "silent_seconds")])


# -- health ----------------------------------------------------------------------------------


def health_latest_rate(spark, sf):
    w = win.window_metrics(events(spark, sf), HOURLY, BY_TYPE)
    return health.latest_rate(w).select("series", half_up(F.col("latest_rate"), 9).alias("latest_rate"))


def health_anomalies_trailing(spark, sf):
    return health.trailing_count(surfaced_by_type(spark, sf), F.col("ts"), span=200_000)


def health_drops_trailing(spark, sf):
    cfg = EngineConfig(max_events_per_sec=1)
    drops = ingest.rate_drops(events(spark, sf), cfg, F.floor(epoch(F.col("ts")) / 600))
    rows = drops.withColumn("series", F.lit("all"))
    return health.trailing_count(rows, F.col("second"), span=30, length=500, weight=F.col("dropped"))


def health_lag(spark, sf):
    w = win.window_metrics(events(spark, sf), TWO)
    processed = F.col("window_end") - 1 + F.col("count")
    return health.processing_lag(w, processed)


def health_throughput(spark, sf):
    ev = with_series(events(spark, sf), BY_TYPE)
    kept = ev.where("NOT bot")
    return health.throughput(ev, kept, epoch(F.col("ts"))).select(
        "series", "minute", half_up(F.col("ingested_per_sec"), 6).alias("ingested_per_sec"),
        half_up(F.col("processed_per_sec"), 6).alias("processed_per_sec"))


def health_anomalies_by_severity(spark, sf):
    return health.anomalies_by_severity(surfaced_by_type(spark, sf))


def health_detector_fires(spark, sf):
    return health.fires_by_detector(explode_results(scored(spark, sf, HOURLY, BY_TYPE)))


def health_duration_p95(spark, sf):
    ev = events(spark, sf)
    return health.duration_p95(ev.withColumn("seconds", F.col("bytes_delta").cast("double")),
                               F.floor(epoch(F.col("ts")) / 288))


# -- frames and reports ---------------------------------------------------------------------------


def metric_frame(spark, sf):
    s = scored(spark, sf, HOURLY, BY_TYPE)
    f = frames.metric_frame(s)
    z = F.filter("detectors", lambda d: d["name"] == "zscore")[0]
    return f.select("type", "series", "t", "ws", "rate", "count", "distinct_subjects", "distinct_actors",
                    "bot_ratio", "bytes_per_sec", "new_rate", z["score"].alias("z_score"),
                    z["flag"].alias("z_flag"), z["available"].alias("z_available"))


def metric_frame_top(spark, sf):
    """Leading values of the two frame dimensions, one row per entry."""
    ev = events(spark, sf)
    w = score_windows(stage(win.window_metrics(ev, HOURLY), "windows"), HOURLY.with_(detectors=("zscore",)))
    nested = win.nest_dims(win.dim_topk(win.dim_counts(ev, HOURLY), HOURLY))
    f = frames.metric_frame(w, nested)
    return f.select("t", F.explode("top").alias("dim", "vals")).select(
        "t", "dim", F.posexplode("vals").alias("pos", "v")).select(
        "t", "dim", "pos", F.col("v.value").alias("value"), F.col("v.cnt").alias("cnt"))


def anomaly_frame(spark, sf):
    d = detect_anomalies(events(spark, sf), HOURLY, BY_TYPE)
    f = frames.as_json(frames.anomaly_frame(d.anomalies))
    return f.select(
        F.get_json_object("value", "$.type").alias("type"),
        F.get_json_object("value", "$.id").alias("id"),
        F.get_json_object("value", "$.severity").alias("severity"),
        F.get_json_object("value", "$.agreement").cast("int").alias("agreement"))


def anomaly_report(spark, sf):
    a = surfaced_by_type(spark, sf)
    r = report.anomaly_report(a, now=F.col("ts") + 5_000)
    return r.select("id", "label", "title", "observed", "expected", "factor", "confidence", "agree",
                    "age", F.array_join(F.transform("fired", lambda x: F.split_part(x, F.lit(" "), F.lit(1))), ",").alias("fired"))


def anomaly_cards(spark, sf):
    """Anomalies as shown with their reasons, one row for each reason."""
    cards = report.anomaly_report(detect_anomalies(events(spark, sf), HOURLY, BY_TYPE).anomalies)
    return cards.select("id", F.posexplode("why").alias("pos", "reason")).select(
        "id", (F.col("pos") + 1).alias("rank"), "reason.label",
        half_up(F.col("reason.width_pct"), 6).alias("width_pct"), "reason.excess")


def tiles(spark, sf):
    return report.tiles(win.window_metrics(events(spark, sf), HOURLY, BY_TYPE))


# -- text -----------------------------------------------------------------------------------------


def bm25(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    asked = spark.read.parquet(f"{sf}/benchmark.parquet")
    return text.bm25(docs, asked, 5, query_id="item_id")


def keyword_category(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return text.keyword_category(docs).select("doc_id", "category", "hits")


# -- streaming ------------------------------------------------------------------------------------


def event_stream(spark, sf) -> DataFrame:
    raw = spark.read.parquet(f"{sf}/events.parquet")
    return tables.normalise_events(
        spark.readStream.schema(raw.schema).parquet(f"{sf}/events*.parquet"))


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over everything there is and return what it wrote."""
    spark = stream.sparkSession
    root = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def stream_windows(spark, sf):
    """Windows closed by the watermark, with ranked dimension values, per event type."""
    closed = closing.closed_windows(event_stream(spark, sf), HOURLY, BY_TYPE)
    return run_to_table(closed, "closed").select(
        "series", "window_id", *win.COUNTS, F.size("dims").alias("n_dims"),
        F.get("dims", 0)["value"].alias("top_domain"), F.get("dims", 0)["cnt"].alias("top_cnt"))


def stream_topk(spark, sf):
    """Ranked values of every dimension of closed windows, over four micro-batches in time order."""
    stream = in_quarters(spark, events(spark, sf))
    closed = run_to_table(closing.closed_windows(stream, HOURLY.with_(dim_topk=3)), "topk")
    return closed.select("series", "window_id", "distinct_actors", F.inline("dims"))


def stream_scores(spark, sf):
    """Gap-free windows scored by the per-series streaming state."""
    run.configure(spark)
    closed = closing.closed_windows(event_stream(spark, sf), HOURLY, BY_TYPE)
    rows = run_to_table(scoring.score_stream(closed, HOURLY), "scores")
    return rows.select("series", "window_id", F.inline("detectors")).select(
        "series", "window_id", "name", "flag", half_up(F.col("score"), 6).alias("score"))


def stream_fold(spark, sf):
    """Late events folded over four micro-batches in order of arrival, then a final flush."""
    root = stage_path(spark, "fold")
    ev = events(spark, sf)
    late = ev.withColumn("seq", (F.col("seq") + 37 * (F.col("seq") % 11)) * 11 + F.col("seq") % 11)
    last = late.agg(F.max("seq").alias("m")).scalar()
    late = stage(late.withColumn("quarter", F.floor(F.col("seq") * 4 / (last + 1))), "arrivals")
    stream = in_batches(
        spark, [late.where(F.col("quarter") == quarter).drop("quarter") for quarter in range(4)], late.count(), "fold")
    query = closing.fold_stream(stream, f"{root}/w", f"{root}/checkpoint", TWO)
    query.awaitTermination()
    closing.flush_open(spark, f"{root}/w", query.lastProgress["batchId"], TWO)
    closed = spark.read.option("recursiveFileLookup", "true").schema(closing.CLOSED_SCHEMA).parquet(f"{root}/w/closed")
    return closed.select("series", "window_id", *win.COUNTS)


def stream_recorded_fold(spark, sf):
    """A recording that grows by four appends, streamed after each one: nothing is late, so the
    windows folded by arrival are those of event time."""
    root = stage_path(spark, "recorded")
    ev = events(spark, sf)
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(first))) * 4 / (
        F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1))
    for part in range(4):
        jsonl.record_events(ev.where(quarter == part).orderBy("ts", "seq"), f"{root}/in", max_records=700)
        stream = run.read_recorded_stream(spark, f"{root}/in", splitBytes=50_000)
        query = closing.fold_stream(stream, f"{root}/w", f"{root}/checkpoint", TWO)
        query.awaitTermination()
    closing.flush_open(spark, f"{root}/w", query.lastProgress["batchId"], TWO)
    closed = spark.read.option("recursiveFileLookup", "true").schema(closing.CLOSED_SCHEMA).parquet(f"{root}/w/closed")
    return closed.select("series", "window_id", *win.COUNTS)


def in_batches(spark, parts: list[DataFrame], rows: int, name: str) -> DataFrame:
    """A stream that takes one of ``parts`` with each micro-batch. All are written in the same number
    of files, which follows the ``rows`` of all, so that no part passes one task."""
    root = stage_path(spark, name)
    n = max(1, -(-rows // (len(parts) * FILE_ROWS)))
    none = spark.createDataFrame([], parts[0].schema)
    for i, part in enumerate(parts):
        (part.coalesce(1) if n == 1 else part.repartition(n)).write.parquet(f"{root}/{i}")
        for _ in range(n - len(spark.read.parquet(f"{root}/{i}").inputFiles())):      # an empty partition leaves none
            none.coalesce(1).write.mode("append").parquet(f"{root}/{i}")
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", n).parquet(f"{root}/*")


def in_quarters(spark, ev: DataFrame) -> DataFrame:
    """Events as a stream of four micro-batches in order of time."""
    micros = F.unix_micros("ts")
    first, last, rows = ev.agg(F.min(micros), F.max(micros), F.count(F.lit(1))).first()
    quarter = F.floor((micros - first) * 4 / (last - first + 1))
    return in_batches(spark, [ev.where(quarter == part) for part in range(4)], rows, "quarters")


def stream_anomalies(spark, sf):
    """Events to the stored metric and anomaly tables: three detectors, several micro-batches."""
    root = stage_path(spark, "live")
    run.stream_anomalies(
        in_quarters(spark, events(spark, sf)), root, f"{root}/checkpoint", THREE).awaitTermination()
    m, a = history.read_metrics(spark, f"{root}/metrics"), history.read_anomalies(spark, f"{root}/anomalies")
    flags = F.aggregate("detectors", F.lit(0), lambda n, d: n + d["flag"].cast("int"))
    none = lambda t: F.lit(None).cast(t)
    return m.select(
        F.lit("metric").alias("kind"), none("string").alias("id"), F.col("window_end").alias("t"), "count",
        none("string").alias("severity"), none("double").alias("score"), flags.alias("agreement"), none("int").alias("n_why"),
    ).unionByName(a.select(
        F.lit("anomaly").alias("kind"), "id", F.col("ts").alias("t"), none("long").alias("count"), "severity", "score",
        "agreement", F.size("why").alias("n_why")))


def stream_bootstrap(spark, sf):
    """The first half of the time scored as a batch, the rest by a stream that takes over its state."""
    run.configure(spark)
    ev = events(spark, sf)
    first, last = ev.agg(F.min(epoch(F.col("ts"))), F.max(epoch(F.col("ts")))).first()
    cut = F.timestamp_seconds(F.floor(F.lit((first + last) / 2) / THREE.tick_seconds) * int(THREE.tick_seconds))
    past, coming = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    windows = stage(win.window_metrics(past, THREE), "windows")
    state = handover.scorer_state(windows, win.dim_topk(win.dim_counts(past, THREE), THREE), THREE)
    closed = closing.closed_windows(in_quarters(spark, coming), THREE)
    live = run_to_table(scoring.score_stream(closed, THREE, initial=state), "live")
    rows = score_windows(windows, THREE).select("series", "window_id", "detectors").unionByName(
        live.select("series", "window_id", "detectors"))
    of = lambda name: F.filter("detectors", lambda d: d["name"] == name)[0]
    return rows.select(
        "series", "window_id", *[of(n)["flag"].alias(f"{n[0]}_flag") for n in THREE.detectors],
        *[half_up(of(n)["score"], 6).alias(f"{n[0]}_score") for n in THREE.detectors])


def stream_idle(spark, sf):
    """Series that fall quiet get empty windows as the watermark passes: purchases of the first
    days only, beside every other event."""
    run.configure(spark)
    ev = events(spark, sf)
    quiet = F.timestamp_seconds(F.lit(int(QUIET_FROM)))
    kept = ev.where((F.col("event_type") != "purchase") | (F.col("ts") < quiet))
    closed = closing.closed_windows(in_quarters(spark, kept), HOURLY, BY_TYPE)
    return run_to_table(scoring.score_stream(closed, HOURLY, idle=True), "idle").select(
        "series", "window_id", "count", F.size("sightings").alias("n_dims"))


def stream_trailing(spark, sf):
    """Events of the last day, hour by hour and per event type, on a stream."""
    ev = with_series(in_quarters(spark, events(spark, sf)), BY_TYPE).withWatermark("ts", "0 seconds")
    return run_to_table(health.trailing_panes(ev, "ts", 86_400, 3_600), "trailing").select(
        "series", F.unix_seconds("until").alias("until"), "trailing")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        normalise_events, normalise_orders, recentchange_normalise, sse_capture, jsonl_replay, source_registry,
        registered_changes, dedupe, rate_cap, rate_drops, retime, replay_gaps,
        window_metrics, window_metrics_by_type, orders_windows, window_metrics_gapfilled,
        flush_windows, fold_late_windows, feature_vector, dim_counts, dim_topk,
        zscore, zscore_both, registered_detector, ewma, ewma_fast, ewma_long_history, ewma_down, hst, detector_results,
        ensemble_candidates, cooldown, anomalies, anomalies_three_detectors, baseline, why,
        anomalies_explained,
        incident_window, recent_metrics, recent_metrics_as_of, recent_anomalies, anomaly_listing,
        last_windows, snapshot, retention, expired_days, stored_recent_metrics, stored_incident,
        stored_incident_one, stored_snapshot, append_idempotent,
        idempotent_append, pipeline_stats,
        trend, agreement, detector_scores, sparkline, series_summary, chart_markers,
        stale_intervals,
        health_latest_rate, health_anomalies_trailing, health_drops_trailing, health_lag,
        health_throughput, health_anomalies_by_severity, health_detector_fires,
        health_duration_p95,
        metric_frame, metric_frame_top, anomaly_frame, anomaly_report, anomaly_cards, tiles,
        bm25, keyword_category,
        stream_windows, stream_topk, stream_scores, stream_fold, stream_recorded_fold,
        stream_anomalies, stream_bootstrap, stream_idle, stream_trailing,
    )
}
