from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.operators import frames, health, history, report, series
from surgemark.operators import windows as win
from surgemark.plans.detection import score_windows, surfaced_windows
from surgemark.plans.staging import stage
from tests.conftest import make_events, make_windows

CFG = EngineConfig(detectors=("zscore", "ewma"), hst_window=20)
VALUES = [10, 11, 9, 10, 12, 8, 10, 11, 9, 10, 10, 11, 9, 10] * 4 + [90, 10, 10, 10, 10, 95, 10]


_STAGED = {}


def scored(spark):
    if "s" not in _STAGED:
        _STAGED["s"] = stage(score_windows(make_windows(spark, VALUES), CFG), "scored")
    return _STAGED["s"]


def surfaced(spark):
    if "a" not in _STAGED:
        _STAGED["a"] = stage(surfaced_windows(scored(spark), CFG), "surfaced")
    return _STAGED["a"]


def test_idempotent_append(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", 90_000.0)], "id string, t double")
    new = rows.select("id", F.timestamp_seconds("t").alias("time"), F.lit(1).alias("v"))
    for _ in range(3):
        history.append_idempotent(new, path)
    more = new.withColumn("v", F.lit(2)).union(
        spark.sql("select 'z' as id, timestamp_seconds(1.0) as time, 2 as v"))
    history.append_idempotent(more, path)
    got = spark.read.parquet(path).orderBy("id").collect()
    assert [(r.id, r.v) for r in got] == [("x", 1), ("y", 1), ("z", 2)]
    assert {str(r.day) for r in got} == {"1970-01-01", "1970-01-02"}


def test_metric_table_default_source(spark):
    t = history.metric_table(scored(spark))
    assert t.first().source == "recentchange" and t.count() == len(VALUES)
    assert history.metric_table(scored(spark), "other").first().source == "other"


def test_recent_metrics_forms(spark):
    w = win.fill_gaps(make_windows(spark, range(1, 11), 0), EngineConfig())
    last = [r.window_end for r in history.recent_metrics(w, CFG, 3).collect()]
    assert last == [7.0, 8.0, 9.0, 10.0]
    assert [r.window_end for r in history.recent_metrics(w, CFG, 3, as_of=10.0).collect()] == [8.0, 9.0, 10.0]
    assert history.clamp_seconds(0, CFG) == 1 and history.clamp_seconds(10 ** 9, CFG) == 86_400


def test_retention_keeps_seven_days(spark):
    rows = spark.sql("select timestamp_seconds(d * 86400) as time from range(20) t(d)")
    assert history.retain(rows, CFG).count() == 8
    assert history.retain(rows, CFG, F.lit("1970-01-10").cast("timestamp")).count() == 18


def test_anomaly_queries_and_incident(spark):
    s = scored(spark)
    a = surfaced(spark)
    rows = history.recent_anomalies(a, 10).collect()
    assert [r.window_id for r in rows] == [161, 156]
    assert history.list_anomalies(a, CFG, 1).count() == 1
    assert history.list_anomalies(a.limit(0).union(a), CFG.with_(anomaly_buffer=1), 50).count() == 1
    cfg = CFG.with_(incident_pad=2.0)
    got = history.incident(rows[1].id, a, s, cfg).collect()
    assert [r.window_id for r in got] == [154, 155, 156, 157, 158]
    assert history.incident("missing", a, s, cfg).count() == 0
    both = history.incidents(a, s, cfg)
    assert both.count() == 9 and both.where("window_id = 159").count() == 1


def test_last_n_and_snapshot(spark):
    s = scored(spark)
    assert [r.window_id for r in history.last_n(s, 2).orderBy("window_id").collect()] == [161, 162]
    assert history.last_n(s, 3, per_series=False).count() == 3
    shot = history.snapshot(s, surfaced(spark), CFG.with_(metric_buffer=5)).first()
    assert [m.window_id for m in shot.metrics] == [158, 159, 160, 161, 162]
    assert [x.window_id for x in shot.anomalies] == [161, 156]


def test_pipeline_stats(spark):
    s = scored(spark)
    ev = make_events(spark, [{"t": 1}, {"t": 2}])
    r = history.pipeline_stats(ev, s, surfaced(spark), CFG.with_(unavailable=("ewma",))).first()
    assert (r.events_seen, r.snapshots, r.anomalies, r.last_rate) == (2, len(VALUES), 2, 10.0)
    assert [(d.name, d.available) for d in r.detectors] == [("zscore", True), ("ewma", False)]


def test_trend(spark):
    w = win.fill_gaps(make_windows(spark, [0] + list(range(1, 40))), EngineConfig())
    for length in (7, 8192):
        t = series.trend(w, "count", length=length).orderBy("window_id").collect()
        assert len(t) == 40 and all(r.trend is None for r in t[:31])
        assert t[31].trend == 30.0 and t[31].direction == "up"


def test_sparkline_and_summary(spark):
    w = win.fill_gaps(make_windows(spark, [2, 4, 3]), EngineConfig())
    pts = series.sparkline(w, "count").orderBy("window_id").collect()
    assert [(r.x, r.y) for r in pts] == [(0.0, 100.0), (50.0, 0.0), (100.0, 50.0)]
    assert series.sparkline(w.limit(1)).count() == 0
    r = series.series_summary(w).first()
    assert (r.peak_rate, r.total_events, r.x_max, r.y_max) == (4.0, 9, 103.0, 5.0)


def test_stale_intervals_cross_chunks(spark):
    ev = make_events(spark, [{"t": t} for t in (0, 1, 4.9, 9.0, 13.0, 13.5, 40, 41)]).withColumn(
        "series", F.lit("all"))
    for chunk in (1, 3, 8192):
        got = series.stale_intervals(ev, EngineConfig(), chunk=chunk).orderBy("silent_from").collect()
        assert [(r.silent_from, r.silent_to) for r in got] == [(4.9, 9.0), (13.5, 40.0)]


def test_agreement_and_scores(spark):
    s = scored(spark)
    r = {x.window_id: x for x in series.agreement(s).collect()}
    assert len(r) == 48 and r[156].agreement == 2 and r[156].available == 2 and r[155].agreement == 0
    sc = series.detector_scores(s, ("zscore", "hst")).where("window_id = 156").first()
    assert sc.zscore > 0.9 and sc.hst == 0.0


def test_chart_markers(spark):
    s = scored(spark)
    assert series.chart_markers(surfaced(spark), s, 5.0).count() == 1


def test_trailing_count_across_slices(spark):
    times = [0, 1, 1, 200, 301, 302, 900]
    rows = make_events(spark, [{"t": t} for t in times]).withColumn("series", F.lit("all"))
    for length in (50, 86_400):
        got = health.trailing_count(rows, F.unix_micros("ts") / 1e6, length=length).collect()
        assert {r.second: r.trailing for r in got} == {
            s: sum(1 for t in times if s - 300 <= t <= s) for s in times}


def test_lag_bands_and_throughput(spark):
    w = win.fill_gaps(make_windows(spark, [1, 1, 1]), EngineConfig())
    lag = health.processing_lag(w, F.col("window_end") + (F.col("window_id") - 100) * 2.5 - 1)
    assert [(r.lag, r.band) for r in lag.orderBy("window_id").collect()] == [
        (0.0, "green"), (1.5, "green"), (4.0, "yellow")]
    ev = make_events(spark, [{"t": 1}, {"t": 2}, {"t": 61}]).withColumn("series", F.lit("all"))
    t = health.throughput(ev, ev.where("seq < 2"), F.unix_micros("ts") / 1e6).orderBy("minute").collect()
    assert [(r.minute, r.ingested_per_sec, r.processed_per_sec) for r in t] == [
        (0, 2 / 60, 2 / 60), (60, 1 / 60, 0.0)]


def test_health_counts(spark):
    s = scored(spark)
    a = surfaced(spark)
    assert sum(r.n for r in health.anomalies_by_severity(a).collect()) == 2
    from surgemark.plans.detection import explode_results
    fires = {(r.minute, r.name): r.n for r in health.fires_by_detector(explode_results(s)).collect()}
    assert sum(fires.values()) >= 3 and all(m % 60 == 0 for m, _ in fires)
    d = spark.range(100).select(F.col("id").cast("double").alias("seconds"))
    assert health.duration_p95(d, F.lit(10.0)).first().p95 == 94.0
    assert health.latest_rate(s).first().latest_rate == 10.0


def test_metric_frame_and_json(spark):
    ev = make_events(spark, [{"t": 0, "dims": {"lang": v, "kind": "x"}} for v in "aabbbcdefgh"])
    w = win.window_metrics(ev, EngineConfig())
    nested = win.nest_dims(win.dim_topk(win.dim_counts(ev, CFG), CFG))
    f = frames.metric_frame(score_windows(w, CFG.with_(unavailable=("ewma",))), nested).first()
    assert f.type == "metric" and f.t == 1.0 and list(f.top) == ["lang"]
    assert [v.value for v in f.top["lang"]] == ["b", "a", "c", "d", "e", "f"]
    assert [d.available for d in f.detectors] == [True, False]
    s = scored(spark)
    text = frames.as_json(frames.anomaly_frame(surfaced(spark))).first().value
    assert text.startswith('{"type":"anomaly","id":')


def test_report_text(spark):
    a = surfaced(spark)
    r = report.anomaly_report(a, now=F.col("ts") + 70).orderBy("ts").first()
    assert r.label == "CRITICAL" and r.title == "rate spike" and r.agree == "2/2 agree"
    assert r.observed == "90" and r.age == "1m ago" and r.factor.endswith("×")
    assert [x.split(" ")[0] for x in r.fired] == ["zscore", "ewma"]


def test_number_formats(spark):
    from surgemark.functions import text_format as tf

    def show(fn, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
        return [r.s for r in df.select("i", fn(F.col("v")).alias("s")).orderBy("i").collect()]

    assert show(tf.compact, 0.25, 9.94, 12.4, 140.0, 1500.0, -2.5e6, float("inf")) == [
        "0.3", "9.9", "12", "140", "1.5k", "-2.5M", "—"]
    assert show(tf.byte_rate, 0.0, 512.0, 1536.0, 20480.0, 5 * 1024.0 ** 3) == [
        "0 B/s", "512 B/s", "1.5 KB/s", "20 KB/s", "5.0 GB/s"]
    assert show(tf.pct, 0.126) == ["13%"] and show(tf.integer, 12345.5) == ["12,346"]
    assert show(lambda c: tf.age(c, F.lit(10_000.0)), 9_990.0, 9_000.0, 10.0, 20_000.0) == [
        "10s ago", "16m ago", "2h ago", "0s ago"]
    assert show(lambda c: tf.clock(c), 3661.9) == ["01:01:01"]


def by_day(spark, tmp_path, days=30):
    rows = spark.range(days * 24).select(
        F.timestamp_seconds(F.col("id") * 3600 + 1800).alias("time"), F.lit("all").alias("series"), F.col("id").alias("count"))
    history.append_by_day(rows, str(tmp_path / "m"))
    return history.read_metrics(spark, str(tmp_path / "m"))


def test_one_incident_reads_its_days_only(spark, tmp_path):
    m = by_day(spark, tmp_path)
    a = spark.range(20).select(
        F.concat(F.lit("a"), "id").alias("id"), (F.col("id") * 86_400 + 86_000).cast("double").alias("ts"),
        F.lit("all").alias("series"), F.lit("warn").alias("severity"))
    a.write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    cfg = EngineConfig(incident_pad=7200.0)
    one = history.incident("a5", a, m, cfg)
    at = 5 * 86_400 + 86_000
    assert [r["count"] for r in one.collect()] == [
        i for i in range(720) if at - 7200 <= i * 3600 + 1800 <= at + 7200]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert history.incident("nobody", a, m, cfg).count() == 0


def test_newest_rows_read_the_last_days_only(spark, tmp_path):
    m = by_day(spark, tmp_path)
    for n, days in ((1, 1), (24, 1), (25, 2), (49, 4), (10_000, 30)):
        found = history.newest_days(m, n)
        assert found.select("day").distinct().count() == days
        got = [r["count"] for r in history.last_n(found, n, "window_end", per_series=False).collect()]
        assert got == list(range(719, max(-1, 719 - n), -1))


def test_rows_without_a_series_are_stored_once(spark, tmp_path):
    rows = spark.sql("select cast(null as string) as series, timestamp_seconds(5) as time, 1 as v")
    for _ in range(2):
        history.append_idempotent(rows, str(tmp_path / "t"), keys=("series", "time"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_expired_days_are_deleted(spark, tmp_path):
    """Whole days before the retention time go; a reader that listed them before loses only them."""
    from datetime import date

    from surgemark.functions.scalar import from_epoch

    path = str(tmp_path / "metrics")
    rows = spark.range(12).select(
        from_epoch(F.lit(1_704_067_200.0) + F.col("id") * 86_400).alias("time"), F.lit("all").alias("series"), "id")
    history.append_by_day(rows, path)
    before = history.read_metrics(spark, path)
    gone = history.drop_expired_days(spark, path, EngineConfig(retention_days=7), date(2024, 1, 12))
    assert gone == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert sorted(r.id for r in before.collect()) == sorted(
        r.id for r in history.read_metrics(spark, path).collect()) == list(range(4, 12))
    assert history.drop_expired_days(spark, str(tmp_path / "none"), EngineConfig(), date(2024, 1, 12)) == []


def test_one_batch_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3).select(F.timestamp_seconds(F.col("id") * 90_000).alias("time"), "id")
    assert history.written_before(spark, path, "r", 0) is None
    for run, batch in (("r", 0), ("r", 1), ("q", 1), ("r", 1)):
        history.write_once(rows.withColumn("n", F.lit(batch)), path, run, batch)
    assert spark.read.parquet(path).count() == 9
    assert history.written_before(spark, path, "r", 1).count() == 6
    history.write_once(rows.where("false").withColumn("n", F.lit(2)), path, "r", 2)
    assert spark.read.parquet(path).count() == 9
