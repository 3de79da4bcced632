import random

from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.operators import windows as win
from tests.conftest import make_events, make_windows

CFG = EngineConfig()


def series_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("window_id").collect()]


def test_count_and_rate(spark):
    ev = make_events(spark, [{"t": 100.2}] * 3 + [{"t": 101.1}])
    assert series_of(win.window_metrics(ev, CFG), "window_id", "count", "rate") == [
        (100, 3, 3.0), (101, 1, 1.0)]


def test_distincts_bytes_and_bot_ratio(spark):
    ev = make_events(spark, [
        {"t": 0.1, "subject": "A", "actor": "u1", "bytes_delta": 100},
        {"t": 0.2, "subject": "A", "actor": "u2", "bytes_delta": -50, "bot": True},
        {"t": 0.3, "subject": "B", "actor": "u1", "bytes_delta": 20},
    ])
    r = win.window_metrics(ev, CFG).first()
    assert (r.distinct_subjects, r.distinct_actors, r.bytes_changed) == (2, 2, 170)
    assert abs(r.bot_ratio - 1 / 3) < 1e-12


def test_empty_names_do_not_count_but_question_mark_does(spark):
    ev = make_events(spark, [{"t": 0, "subject": "", "actor": "?"}, {"t": 0, "subject": "x", "actor": "a"}])
    r = win.window_metrics(ev, CFG).first()
    assert (r.distinct_subjects, r.distinct_actors) == (1, 2)


def test_gaps_are_filled(spark):
    w = win.window_metrics(make_events(spark, [{"t": 0.5}, {"t": 4.5}]), CFG)
    closed = win.fill_gaps(w, CFG.with_(emit_open=False))
    assert series_of(closed, "window_start", "count") == [(0, 1), (1, 0), (2, 0), (3, 0)]
    assert series_of(win.fill_gaps(w, CFG), "count") == [(1,), (0,), (0,), (0,), (1,)]


def test_flush_closes_windows_before_the_clock(spark):
    cfg = CFG.with_(tick_seconds=2)
    w = win.window_metrics(make_events(spark, [{"t": 0}]), cfg)
    assert series_of(win.fill_gaps(w, cfg, flush_to=5), "window_start", "count") == [(0, 1), (2, 0)]


def test_flush_behind_the_last_window_keeps_it_open(spark):
    w = win.window_metrics(make_events(spark, [{"t": 0}, {"t": 3}]), CFG)
    assert series_of(win.fill_gaps(w, CFG, flush_to=1), "window_id") == [(0,), (1,), (2,)]


def test_topk_dimensions_keep_first_seen_on_ties(spark):
    rows = [{"t": 0, "dims": {"lang": v}} for v in ["en"] * 5 + ["de"] * 3 + ["fr"]]
    ev = make_events(spark, rows)
    cfg = CFG.with_(dim_topk=2)
    top = win.dim_topk(win.dim_counts(ev, cfg), cfg).orderBy("rk").collect()
    assert [(r.value, r.cnt) for r in top] == [("en", 5), ("de", 3)]
    ties = make_events(spark, [{"t": 0, "dims": {"lang": v}} for v in ["z", "a", "m", "a", "z", "m"]])
    top = win.dim_topk(win.dim_counts(ties, cfg), cfg).orderBy("rk").collect()
    assert [r.value for r in top] == ["z", "a"]


def test_untracked_and_blank_dimensions_are_ignored(spark):
    ev = make_events(spark, [{"t": 0, "dims": {"lang": "", "other": "x", "kind": "new"}}])
    assert [(r.dim, r.value) for r in win.dim_counts(ev, CFG).collect()] == [("kind", "new")]


def test_same_window_event_after_newer_one_is_not_late(spark):
    cfg = CFG.with_(late="fold")
    w = win.window_metrics(make_events(spark, [{"t": 0.9}, {"t": 0.5}]), cfg)
    assert series_of(win.fill_gaps(w, cfg, flush_to=1.5), "count") == [(2,)]


def test_late_event_counts_in_the_open_window(spark):
    cfg = CFG.with_(late="fold")
    w = win.window_metrics(make_events(spark, [{"t": 0.5}, {"t": 3.2}, {"t": 1.0}]), cfg)
    assert series_of(w, "window_id", "count") == [(0, 1), (3, 2)]


def test_fold_late_equals_sequential_roll_across_chunks(spark):
    rng = random.Random(3)
    rows = [{"t": i * 0.4 + rng.choice([0, 0, -5, 7, -30]) + 100} for i in range(600)]
    placed = win.place_events(make_events(spark, rows), CFG)
    got = {r.seq: r.window_id for r in win.fold_late(placed, chunk_rows=37).collect()}
    clock, want = None, {}
    for i, r in enumerate(rows):
        bid = int(r["t"] // 1)
        clock = bid if clock is None else max(clock, bid)
        want[i] = clock
    assert got == want


def test_dense_slices_cover_every_window_once_with_halo(spark):
    cfg = CFG.with_(slice_windows=7)
    rng = random.Random(5)
    ids = sorted(rng.sample(range(1000, 1300), 25))
    w = spark.createDataFrame(
        [("s", i, i, 0, 0, 0, 0, 0) for i in ids], make_windows(spark, [1]).schema)
    d = win.dense_slices(w, cfg, halo=10, length=7)
    own = [(r.window_id, r["count"]) for r in d.where("in_slice").orderBy("window_id").collect()]
    assert own == [(i, i if i in ids else 0) for i in range(ids[0], ids[-1] + 1)]
    for r in d.groupBy("slice").agg(
            F.min("window_id").alias("a"), F.max("window_id").alias("b"), F.count("*").alias("n")).collect():
        assert r.a == max(ids[0], r.slice * 7 - 10) and r.b == min(ids[-1], r.slice * 7 + 6)
        assert r.n == r.b - r.a + 1


def test_series_are_independent(spark):
    ev = make_events(spark, [{"t": 0, "kind": "a"}, {"t": 3, "kind": "a"}, {"t": 1, "kind": "b"}])
    w = win.window_metrics(ev, CFG, ("kind",))
    got = [(r.series, r.window_id, r["count"]) for r in win.fill_gaps(w, CFG).orderBy("series", "window_id").collect()]
    assert got == [("a", 0, 1), ("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 1, 1)]


def test_feature_map_has_the_seven_names(spark):
    w = win.window_metrics(make_events(spark, [{"t": 0}]), CFG)
    m = w.select(win.feature_map().alias("m")).first().m
    assert set(m) == {"rate", "count", "distinct_subjects", "distinct_actors", "bot_ratio",
                      "bytes_per_sec", "new_rate"}


def test_nested_dims_keep_rank_order(spark):
    ev = make_events(spark, [{"t": 0, "dims": {"lang": v}} for v in ["b", "a", "a"]])
    nested = win.nest_dims(win.dim_topk(win.dim_counts(ev, CFG), CFG)).first()
    assert [(x.value, x.cnt) for x in nested.dim_counts["lang"]] == [("a", 2), ("b", 1)]
