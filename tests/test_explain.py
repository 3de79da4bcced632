import random

from surgemark.config import EngineConfig
from surgemark.operators.explain import baselines, contributions, nest_contributions


def sightings(spark, per_window, series="all"):
    """per_window: list of {dim: {value: cnt}}."""
    rows = []
    for w, dims in enumerate(per_window):
        for dim, counts in dims.items():
            for rk, (value, cnt) in enumerate(sorted(counts.items(), key=lambda kv: -kv[1]), 1):
                rows.append((series, w, dim, value, cnt, rk))
    return spark.createDataFrame(
        rows, "series string, window_id long, dim string, value string, cnt long, rk int")


def why(spark, history, last, **cfg):
    cfg = EngineConfig(**cfg)
    levels = baselines(sightings(spark, history + [last]), cfg)
    ranked = contributions(levels.where(f"window_id = {len(history)}"), cfg)
    return ranked.orderBy("rank").collect()


def test_surging_slice_is_named(spark):
    steady = [{"domain": {"en": 10, "de": 5}}] * 20
    r = why(spark, steady, {"domain": {"en": 200, "de": 5}}, baseline_alpha=0.5)
    assert (r[0].dim, r[0].value, r[0].observed) == ("domain", "en", 200)
    assert r[0].excess > 150 and r[0].share > 0.5


def test_nothing_above_min_excess(spark):
    assert why(spark, [{"domain": {"en": 10}}] * 20, {"domain": {"en": 11}},
               baseline_alpha=0.5, why_min_excess=5.0) == []


def test_shares_sum_to_one_within_a_dimension(spark):
    r = why(spark, [{"domain": {"a": 1, "b": 1}}] * 10, {"domain": {"a": 100, "b": 60}},
            baseline_alpha=0.5, why_top_n=10)
    assert abs(sum(x.share for x in r) - 1.0) < 1e-6


def test_share_uses_all_values_before_the_cut(spark):
    last = {"domain": {c: 10 for c in "abcdefghij"}}
    r = why(spark, [{"domain": {"z": 1}}], last)
    assert len(r) == 6 and all(x.share == 0.1 for x in r)


def test_equal_excess_keeps_dimension_order(spark):
    r = why(spark, [{"domain": {"z": 1}}], {"lang": {"en": 5}, "domain": {"d": 5}, "kind": {"k": 5}})
    assert [x.dim for x in r] == ["domain", "lang", "kind"]


def test_sparse_sliced_scan_equals_dense_recursion(spark):
    rng = random.Random(4)
    weights = {"hot": 0.9, "warm": 0.2, "rare": 0.02, "burst": 0.0}
    history = []
    for w in range(900):
        counts = {v: rng.randint(1, 30) for v, p in weights.items() if rng.random() < p}
        if 300 < w < 320:
            counts["burst"] = 500
        history.append({"domain": counts} if counts else {})
    for alpha in (0.05, 0.3):
        cfg = EngineConfig(baseline_alpha=alpha)
        level, want = {}, {}
        for w, dims in enumerate(history):
            counts = dims.get("domain", {})
            for v in counts:
                want[(w, v)] = level.get(v, 0.0)
            for v in set(level) | set(counts):
                level[v] = (1 - alpha) * level.get(v, 0.0) + alpha * counts.get(v, 0)
                if level[v] < cfg.baseline_prune and v not in counts:
                    del level[v]
        for length in (97, None):
            got = {(r.window_id, r.value): r.baseline
                   for r in baselines(sightings(spark, history), cfg, length).collect()}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_nested_why_is_ordered(spark):
    cfg = EngineConfig()
    levels = baselines(sightings(spark, [{"domain": {"a": 3, "b": 9}}]), cfg)
    row = nest_contributions(contributions(levels, cfg)).first()
    assert [c.value for c in row.why] == ["b", "a"]


def test_baselines_run_in_the_jvm(spark):
    plan = baselines(sightings(spark, [{"domain": {"a": 3}}]), EngineConfig())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "InPandas" not in text


def test_many_sightings_of_one_value_in_one_slice(spark):
    cfg = EngineConfig(baseline_alpha=0.3)
    counts = [7 + i % 5 for i in range(1_500)]
    rows = spark.createDataFrame([("all", w, "domain", "a", n, 1) for w, n in enumerate(counts)],
                                 "series string, window_id long, dim string, value string, cnt long, rk int")
    got = {r.window_id: r.baseline for r in baselines(rows, cfg, 2_000).collect()}
    level = 0.0
    for w, n in enumerate(counts):
        assert abs(got[w] - level) < 1e-9
        level = 0.7 * level + 0.3 * n
    assert len(got) == len(counts)
    assert baselines(rows.limit(0), cfg).count() == 0
