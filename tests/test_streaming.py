import time

import pytest
from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.operators import history
from surgemark.operators import windows as win
from surgemark.plans.detection import detect_anomalies
from surgemark.streaming import closing, run, scoring
from tests.conftest import make_events

CFG = EngineConfig(
    tick_seconds=10, cooldown_seconds=40, hst_window=12, hst_trees=4, hst_height=4, hst_warmup=20,
    zscore_window=20, dim_topk=3)


def story():
    """Time-ordered events of two series with a quiet stretch and two spikes."""
    rows = []
    for s, base in (("a", 0), ("b", 3)):
        for w in range(60):
            n = 0 if 20 <= w < 26 else 4 + (w * 7 + base) % 3
            n += 60 if w in (30, 31, 55) and s == "a" else 0
            for i in range(n):
                rows.append({"t": 1000 + 10 * w + 9.9 * i / max(n, 1), "kind": s, "subject": f"p{i % 9}",
                             "actor": f"u{i % 5}", "bot": i % 4 == 0, "bytes_delta": i * (-1) ** i,
                             "dims": {"lang": f"l{i % 5}", "kind": s}})
    rows.sort(key=lambda r: r["t"])
    return [{**r, "seq": i} for i, r in enumerate(rows)]


@pytest.fixture()
def small_shuffle(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    run.configure(spark)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def feed(spark, ev, path, cuts):
    """Write ``ev`` as time-ordered files, one per micro-batch."""
    for lo, hi in zip(cuts, cuts[1:]):
        ev.where(F.col("seq").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)


def view(table):
    out = {}
    for r in table.collect():
        d = [(x.name, x.flag, round(x.score, 8), round(x.expected, 8), x.detail.warmup) for x in r.detectors]
        out[(r.series, r.time)] = (r["count"], r.distinct_subjects, r.distinct_actors,
                                   round(r.bot_ratio, 9), round(r.bytes_per_sec, 9), round(r.new_rate, 9), d)
    return out


def test_stream_equals_batch(spark, tmp_path, small_shuffle):
    rows = story()
    ev = make_events(spark, rows)
    stream = feed(spark, ev, str(tmp_path / "in"), [0, 200, 330, len(rows)])
    seen = []
    durations = run.BatchDurations()
    spark.streams.addListener(durations)
    q = run.stream_anomalies(
        stream, str(tmp_path / "out"), str(tmp_path / "ck"), CFG, ("kind",),
        on_metric=lambda df: seen.append(df.count()))
    q.awaitTermination()
    assert q.exception() is None
    batch = detect_anomalies(ev, CFG, ("kind",))
    want = view(history.metric_table(batch.windows))
    got = view(spark.read.parquet(str(tmp_path / "out" / "metrics")))
    # The newest windows stay open until the watermark passes them.
    assert got and set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(want) - len(got) <= 4 and sum(seen) == len(got)
    last = max(t for _, t in got)

    def found(df):
        return {(r.id, r.severity, r.score, r.agreement,
                 tuple((c.dim, c.value, c.observed, c.baseline, c.share) for c in r.why))
                for r in df.collect()}

    stored = spark.read.parquet(str(tmp_path / "out" / "anomalies"))
    expected = history.anomaly_table(batch.anomalies).where(F.col("time") <= F.lit(last))
    assert found(stored) == found(expected) and stored.count() >= 2
    deadline = time.time() + 20
    while not durations.rows and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(durations)
    assert durations.frame(spark).count() >= 1


def test_replayed_batch_changes_nothing(spark, tmp_path, small_shuffle):
    ev = make_events(spark, story())
    scored = detect_anomalies(ev, CFG, ("kind",)).windows
    rows = scored.select("series", "window_id", *win.COUNTS, "detectors").withColumn(
        "sightings", F.array().cast(f"array<{scoring.SIGHTING}>"))
    out = str(tmp_path / "out")
    for _ in range(2):
        run.write_batch(rows, 0, out, CFG)
    assert spark.read.parquet(f"{out}/metrics").count() == scored.count()
    a = spark.read.parquet(f"{out}/anomalies")
    assert a.count() == a.select("id").distinct().count() > 0


def test_late_events_are_dropped_by_the_watermark(spark, tmp_path, small_shuffle):
    times = [(0, 1), (1, 50), (2, 51), (3, 90), (4, 2), (5, 91), (6, 200)]
    ev = make_events(spark, [{"t": t, "seq": i} for i, t in times])
    stream = feed(spark, ev, str(tmp_path / "in"), [0, 3, 4, 5, 6, 7])
    q = (closing.closed_windows(stream, CFG).writeStream.format("memory").queryName("closed")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.window_id: r["count"] for r in spark.table("closed").collect()}
    assert got == {0: 1, 5: 2, 9: 2}


def test_fold_stream_keeps_every_event(spark, tmp_path, small_shuffle):
    rows = story()[:300]
    for i in range(0, 300, 17):
        rows[i]["t"] -= 45
    ev = make_events(spark, rows)
    stream = feed(spark, ev, str(tmp_path / "in"), [0, 90, 170, 230, 300])
    closing.fold_stream(stream, str(tmp_path / "w"), str(tmp_path / "ck"), CFG, ("kind",)).awaitTermination()
    cfg = CFG.with_(late="fold", emit_open=False)
    want = win.window_metrics(ev, cfg, ("kind",))
    last = {r.series: r.m for r in want.groupBy("series").agg(F.max("window_id").alias("m")).collect()}
    pick = lambda df: {
        (r.series, r.window_id): (r["count"], r.distinct_subjects, r.distinct_actors, r.bytes_changed)
        for r in df.collect() if r.window_id < last[r.series]}
    got = spark.read.schema(closing.CLOSED_SCHEMA).parquet(str(tmp_path / "w" / "closed"))
    assert pick(got) == pick(want) and got.count() == len(pick(want))
    open_rows = spark.read.parquet(str(tmp_path / "w" / "open" / "3")).count()
    assert got.agg(F.sum("count")).first()[0] + open_rows == 300
    # The closed windows feed the scorer as a stream of their own.
    q = (scoring.score_stream(closing.read_closed(spark, str(tmp_path / "w")), CFG).writeStream
         .format("memory").queryName("folded").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    dense = spark.table("folded")
    assert dense.agg(F.sum("count")).first()[0] == 300 - open_rows
    for r in dense.groupBy("series").agg(
            F.min("window_id").alias("a"), F.max("window_id").alias("b"), F.count("*").alias("n")).collect():
        assert r.n == r.b - r.a + 1


def test_fold_policy_reaches_the_sinks(spark, tmp_path, small_shuffle):
    """Late events are counted in the open window, end to end; open events of old batches go."""
    cfg = CFG.with_(late="fold")
    rows = [{"t": 10 * i + 1, "seq": i} for i in range(12)]
    rows[8]["t"] = 5                      # late: falls into the window open at its arrival
    for i in range(4):
        make_events(spark, rows[3 * i:3 * i + 3]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(make_events(spark, rows[:1]).schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    run.stream_anomalies(stream, str(tmp_path / "out"), str(tmp_path / "ck"), cfg).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out" / "metrics"))
    closed = spark.read.option("recursiveFileLookup", "true").schema(closing.CLOSED_SCHEMA).parquet(
        str(tmp_path / "out" / "fold" / "closed"))
    assert stored.agg(F.sum("count")).first()[0] == closed.agg(F.sum("count")).first()[0] == 11
    assert sorted(p.name for p in (tmp_path / "out" / "fold" / "open").iterdir() if p.is_dir()) == ["2", "3"]


def test_idle_series_emits_empty_windows(spark, tmp_path, small_shuffle):
    rows = [{"t": t, "kind": "a"} for t in (0, 11, 21)] + [{"t": t, "kind": "b"} for t in (25, 61, 101, 141)]
    ev = make_events(spark, [{**r, "seq": i} for i, r in enumerate(rows)])
    stream = feed(spark, ev, str(tmp_path / "in"), [0, 4, 5, 6, 7])
    closed = closing.closed_windows(stream, CFG, ("kind",))
    q = (scoring.score_stream(closed, CFG, idle=True).writeStream.format("memory").queryName("idle")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {}
    for r in spark.table("idle").collect():
        got.setdefault(r.series, []).append((r.window_id, r["count"]))
    a = sorted(got["a"])
    assert a[:3] == [(0, 1), (1, 1), (2, 1)]
    assert len(a) > 5 and [w for w, _ in a] == list(range(len(a))) and all(n == 0 for _, n in a[3:])
    assert {w: n for w, n in got["b"] if n} == {2: 1, 6: 1, 10: 1}


def test_recorded_lines_and_messages_as_streams(spark, tmp_path, small_shuffle):
    from surgemark.sources import jsonl

    ev = make_events(spark, [{"t": t, "seq": t} for t in range(5)])
    jsonl.record_events(ev, str(tmp_path / "r"))
    q = (run.read_recorded_stream(spark, str(tmp_path / "r")).writeStream.format("memory")
         .queryName("rec").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("rec").count() == 5
    msgs = jsonl.recordable(ev).select(F.to_json(F.struct("*")).alias("d"), F.lit(3).alias("offset"))
    assert run.decode_stream(msgs).where("seq = 3 and source = 'test'").count() == 5


def test_dedupe_stream(spark, tmp_path, small_shuffle):
    ev = make_events(spark, [{"t": 1, "seq": 0}, {"t": 1, "seq": 1}, {"t": 2, "seq": 2}]).withColumn(
        "id", F.lit("same"))
    stream = feed(spark, ev, str(tmp_path / "in"), [0, 1, 3])
    q = (closing.dedupe_stream(stream, "10 seconds").writeStream.format("memory").queryName("dd")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dd").count() == 1


@pytest.mark.parametrize("salts", [1, 4])
def test_leading_values_of_a_window_with_very_many(spark, tmp_path, small_shuffle, salts):
    """Values of one dimension by the thousand: K of them stay, ties by arrival, in small blocks."""
    n = 6_000
    rows = [{"t": 1 + i / n, "seq": i, "subject": f"p{i % 3000}", "dims": {"lang": f"v{i % 5000}", "domain": f"d{i}"}}
            for i in range(n)] + [{"t": 50, "seq": n}]
    ev = make_events(spark, rows).repartition(3)
    ev.write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        q = (closing.closed_windows(spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in")), CFG, salts=salts).writeStream
             .format("memory").queryName(f"many{salts}").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    row = spark.table(f"many{salts}").where("window_id = 0").first()
    assert (row["count"], row.distinct_subjects, row.distinct_actors) == (n, 3000, 1)
    assert [(d.dim, d.rk, d.value, d.cnt) for d in row.dims] == [
        *[("domain", i + 1, f"d{i}", 1) for i in range(3)], *[("lang", i + 1, f"v{i}", 2) for i in range(3)]]


def tables_of(spark, out):
    metrics = spark.read.parquet(f"{out}/metrics")
    anomalies = spark.read.parquet(f"{out}/anomalies")
    return (
        sorted((r.series, r.time, r["count"]) for r in metrics.collect()),
        sorted((r.id, r.severity, r.score, len(r.why)) for r in anomalies.collect()))


def test_failure_between_the_tables_and_a_replay(spark, tmp_path, small_shuffle, monkeypatch):
    """A batch that fails after its metrics are written is repeated; both tables end as without it."""
    rows = story()
    ev = make_events(spark, rows)
    stream = lambda: spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    feed(spark, ev, str(tmp_path / "in"), [0, 330, len(rows)])
    start = lambda name: run.stream_anomalies(
        stream(), str(tmp_path / name), str(tmp_path / f"{name}-ck"), CFG, ("kind",))
    start("whole").awaitTermination()
    write, calls = run.write_once, []

    def failing(df, path, *args):
        calls.append(path)
        if path.endswith("anomalies") and len(calls) >= 4:
            raise RuntimeError("lost")
        return write(df, path, *args)

    monkeypatch.setattr(run, "write_once", failing)
    q = start("cut")
    with pytest.raises(Exception):
        q.awaitTermination()
    monkeypatch.setattr(run, "write_once", write)
    start("cut").awaitTermination()
    assert len(calls) == 4
    whole = tables_of(spark, str(tmp_path / "whole"))
    assert tables_of(spark, str(tmp_path / "cut")) == whole and whole[1]


@pytest.mark.parametrize("cut", [3, 40])
def test_stream_goes_on_from_a_batch(spark, tmp_path, small_shuffle, cut):
    """History by batch, the rest by a stream: scores and baselines as of the batch over all."""
    from surgemark.streaming import handover

    cfg = CFG.with_(ewma_alpha=0.9, zscore_window=20)    # forgets in 50 windows
    rows = story() + [{"t": 1000 + 10 * 120, "kind": s, "dims": {"lang": "l1"}} for s in "ab"]
    ev = make_events(spark, [{**r, "seq": i} for i, r in enumerate(rows)])
    at = F.timestamp_seconds(F.lit(1000 + 10 * cut))
    past, coming = ev.where(F.col("ts") < at), ev.where(F.col("ts") >= at)
    windows = win.window_metrics(past, cfg, ("kind",))
    topk = lambda e: win.dim_topk(win.dim_counts(e, cfg, ("kind",)), cfg)
    state = handover.scorer_state(windows, topk(past), cfg)
    coming.coalesce(1).write.parquet(str(tmp_path / "in"))
    closed = closing.closed_windows(
        spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in")), cfg, ("kind",))
    name = f"going{cut}"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        (scoring.score_stream(closed, cfg, initial=state).writeStream.format("memory").queryName(name)
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = view(history.metric_table(detect_anomalies(ev, cfg, ("kind",)).windows))
    got = view(history.metric_table(run.scored_view(spark.table(name), cfg)))
    assert len(got) == 2 * (60 - cut) and all(got[k] == want[k] for k in got)
    from surgemark.operators.explain import baselines
    level = lambda df: {(r.series, r.window_id, r.dim, r.value): round(r.baseline, 8) for r in df.collect()}
    base = level(baselines(topk(ev), cfg))
    seen = level(spark.table(name).select("series", "window_id", F.inline("sightings")))
    assert seen and all(base[k] == v for k, v in seen.items())


def test_state_of_an_empty_history(spark):
    from surgemark.streaming import handover

    ev = make_events(spark, [{"t": 1}]).where("false")
    assert handover.scorer_state(
        win.window_metrics(ev, CFG), win.dim_topk(win.dim_counts(ev, CFG), CFG), CFG).count() == 0


class Held:
    """One value or map of state, as the scorer uses it."""
    def __init__(self):
        self.held = {}

    def exists(self):
        return "row" in self.held

    def get(self):
        return self.held["row"]

    def update(self, row):
        self.held["row"] = row

    def iterator(self):
        return iter(list(self.held.items()))

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


def test_long_gap_comes_in_blocks():
    """Two hundred thousand empty windows: no frame holds more than a block, none is left out."""
    import pandas as pd

    cfg = CFG.with_(detectors=("zscore", "ewma"))
    scorer = scoring.WindowScorer(cfg, idle=False)
    scorer.core, scorer.levels = Held(), Held()
    row = {c: 1 for c in win.COUNTS}
    frame = pd.DataFrame([{**row, "window_id": w, "dims": [{"dim": "lang", "value": "x", "cnt": 1, "rk": 1}]}
                          for w in (5, 200_005)])
    sizes, at = [], 5
    for out in scorer.handleInputRows(("a",), iter([frame]), None):
        sizes.append(len(out))
        assert out["window_id"].iloc[0] == at
        at += len(out)
    assert max(sizes) == scoring.BLOCK and sum(sizes) == 200_001
    assert out["sightings"].iloc[-1][0]["baseline"] == 0.0


def frames_of(rows, size):
    import pandas as pd

    names = [f.split()[0] for f in closing.PARTIAL.split(", ")]
    return iter([pd.DataFrame(rows[i:i + size], columns=names) for i in range(0, len(rows), size)])


@pytest.mark.parametrize("held", [7, 50_000])
def test_windows_pass_the_leading_values_many_at_a_time(monkeypatch, held):
    """Forty windows in frames that cut them anywhere, against sorting each window's values."""
    import random

    import pandas as pd

    monkeypatch.setattr(closing, "HELD", held)
    rng, at, rows, want = random.Random(3), pd.Timestamp(0), [], {}
    for w in range(40):
        values = [(d, f"v{i}", rng.randint(1, 4), rng.choice([i, closing.LAST_SEQ])) for d in ("lang", "kind") for i in range(9)]
        rows += [("s", w, d, v, n, first, 0, 0, 0, at) for d, v, n, first in values]
        rows += [("s", w, closing.ACTOR, f"u{i}", 5, 1, 0, 0, 0, at) for i in range(w % 4)]
        rows.append(("s", w, closing.TOTAL, "all", 30 + w, 0, 2, 3, 4 * w, at))
        order = lambda d: sorted((-n, first, v) for x, v, n, first in values if x == d)[:CFG.dim_topk]
        want[w] = (30 + w, 0, w % 4, 2, 3, 4 * w, [
            (d, i + 1, v, -n) for d in CFG.track_dims if d in ("lang", "kind") for i, (n, _, v) in enumerate(order(d))])
    rng.shuffle(rows)
    whole = pd.concat(closing.LeadingValues(CFG, True).handleInputRows((1,), frames_of(rows, 11), None))
    half = [p for i in (0, 1) for f in closing.LeadingValues(CFG, False).handleInputRows((i,), frames_of(rows[i::2], 11), None)
            for p in f.itertuples(index=False, name=None)]
    salted = pd.concat(closing.LeadingValues(CFG, True, True).handleInputRows((1,), frames_of(half, 11), None))
    for found in (whole, salted):
        assert {r.window_id: (r[2], r.distinct_subjects, r.distinct_actors, r.bot_count, r.new_count, r.bytes_changed, [
            (d["dim"], d["rk"], d["value"], d["cnt"]) for d in r.dims]) for r in found.itertuples(index=False)} == want


def test_made_batches_have_as_many_files_as_their_rows_need(spark, tmp_path, monkeypatch):
    """Each micro-batch takes one part, also an empty one, and no part is written by one task."""
    from checks import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    ev = spark.range(120).selectExpr("id", "id % 3 AS part")
    parts = [ev.where(f"part = {i}") for i in range(4)]
    seen = []
    q = (queries.in_batches(spark, parts, 120, "made").writeStream.option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).foreachBatch(
             lambda df, n: seen.append((df.rdd.getNumPartitions() > 1, sorted({r.part for r in df.collect()}), df.count()))).start())
    q.awaitTermination()
    assert [s[1:] for s in seen] == [([0], 40), ([1], 40), ([2], 40), ([], 0)]
