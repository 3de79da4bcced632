import random

from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.operators.ensemble import (
    anomaly_id, apply_cooldown, collect_results, ensemble,
)
from surgemark.schemas import RESULT

CFG = EngineConfig()


def judge(spark, *results, cfg=CFG):
    """results: (name, flag, score[, unavailable]) of one window."""
    rows = [
        ("all", "rate", 1, 0.0, 1.0, name, flag, score, 400.0, 100.0,
         (None, None, None, None, None, None, True if rest else None))
        for name, flag, score, *rest in results
    ]
    long = spark.createDataFrame(
        rows, "series string, metric string, window_id long, window_start double, window_end double, "
              "name string, flag boolean, score double, value double, expected double, "
              f"detail {RESULT['detail'].dataType.simpleString()}")
    return ensemble(collect_results(long), cfg).collect()


def test_nothing_fired(spark):
    assert judge(spark, ("zscore", False, 0.1), ("ewma", False, 0.2)) == []


def test_single_strong_detector(spark):
    (a,) = judge(spark, ("zscore", True, 0.95))
    assert a.agreement == 1 and a.score >= 0.9 and a.expected == 100.0 and a.value == 400.0


def test_agreement_raises_severity(spark):
    (a,) = judge(spark, ("zscore", True, 0.8), ("ewma", True, 0.8), ("hst", True, 0.8))
    assert a.agreement == 3 and a.score >= 0.8 and a.severity == "critical"


def test_one_of_three_is_suppressed(spark):
    assert judge(spark, ("zscore", True, 0.8), ("ewma", False, 0.1), ("hst", False, 0.1)) == []


def test_unavailable_does_not_count(spark):
    (a,) = judge(spark, ("zscore", True, 0.8), ("ewma", True, 0.8), ("hst", False, 0.0, True))
    assert a.score >= 0.8 and a.agreement == 2 and [d.name for d in a.detectors] == ["zscore", "ewma", "hst"]


def test_corroborated_strong_signal_gets_a_bonus(spark):
    (a,) = judge(spark, ("zscore", True, 0.93), ("ewma", True, 0.6), ("hst", False, 0.0))
    assert a.score == 0.56 and a.severity == "info"
    (a,) = judge(spark, ("zscore", True, 1.0), ("ewma", True, 1.0))
    assert a.score == 1.0 and a.severity == "critical"


def test_full_agreement_of_weak_detectors_warns(spark):
    (a,) = judge(spark, ("zscore", True, 0.55), ("ewma", True, 0.55))
    assert a.severity == "warn"


def candidates(spark, times, series="all"):
    return spark.createDataFrame(
        [(series, "rate", float(t), int(t)) for t in times],
        "series string, metric string, window_end double, window_id long")


def greedy(times, cd):
    kept, last = [], -1e9
    for t in sorted(times):
        if t - last >= cd:
            kept.append(t)
            last = t
    return kept


def test_cooldown_case(spark):
    out = apply_cooldown(candidates(spark, [10, 12, 16]), CFG.with_(cooldown_seconds=5.0))
    assert sorted(r.window_end for r in out.collect()) == [10.0, 16.0]


def test_cooldown_equals_greedy_walk_across_chunks(spark):
    rng = random.Random(9)
    a = sorted(rng.sample(range(0, 900), 400))
    b = sorted(rng.sample(range(0, 5000), 200))
    c = list(range(0, 300))
    both = candidates(spark, a, "a").union(candidates(spark, b, "b")).union(candidates(spark, c, "c"))
    for cd in (3.0, 7.0, 20.0):
        for spans in (1, 2, 50):
            out = apply_cooldown(both, CFG.with_(cooldown_seconds=cd), chunk_spans=spans)
            got = {s: [] for s in "abc"}
            for r in out.collect():
                got[r.series].append(r.window_end)
            for s, times in (("a", a), ("b", b), ("c", c)):
                assert sorted(got[s]) == greedy(times, cd), (s, cd, spans)


def test_cooldown_is_per_metric(spark):
    df = candidates(spark, [1, 2]).union(
        candidates(spark, [2]).withColumn("metric", F.lit("count")))
    out = apply_cooldown(df, CFG)
    assert sorted((r.metric, r.window_end) for r in out.collect()) == [("count", 2.0), ("rate", 1.0)]


def test_ids_do_not_change_between_runs(spark):
    df = candidates(spark, [10, 20])
    ids = lambda: [r.id for r in df.select(anomaly_id().alias("id")).collect()]
    assert ids() == ids() and len(set(ids())) == 2 and all(len(i) == 12 for i in ids())
