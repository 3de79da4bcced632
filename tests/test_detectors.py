import random

import numpy as np
import pytest

from surgemark.config import EngineConfig
from surgemark.operators import detectors
from surgemark.operators.detectors import hst
from surgemark.plans.detection import explode_results, score_windows
from surgemark.streaming.scoring import ewma_step, zscore_step
from tests.conftest import make_windows

CFG = EngineConfig(zscore_threshold=3.0, ewma_threshold=3.0, direction="both")
NOISE = [100, 101, 99, 100, 102, 98, 100, 101, 99, 100, 100, 101, 99, 100, 101, 100, 99, 100, 101, 99]


def run(spark, values, name, **changes):
    cfg = CFG.with_(detectors=(name,), **changes)
    rows = explode_results(score_windows(make_windows(spark, values), cfg))
    return rows.orderBy("window_id").collect()


def test_zscore_quiet_on_noise(spark):
    assert not any(r.flag for r in run(spark, NOISE, "zscore"))


def test_zscore_flags_spike(spark):
    r = run(spark, NOISE[:14] + [400], "zscore")
    assert not any(x.flag for x in r[:-1])
    assert r[-1].flag and r[-1].score > 0.5 and r[-1].detail.z > 3 and r[-1].expected < 150


def test_zscore_up_ignores_drops(spark):
    r = run(spark, [100] * 20 + [0, 100, 500], "zscore", direction="up", zscore_window=30)
    assert not r[20].flag and r[22].flag


def test_flat_history_uses_fixed_score(spark):
    for name in ("zscore", "ewma"):
        r = run(spark, [5] * 20 + [6], name, direction="up")
        assert r[-1].flag and r[-1].score == 0.6 and r[-1].detail.z == 0.0
        r = run(spark, [5] * 20 + [4], name, direction="up")
        assert not r[-1].flag and r[-1].score == 0.0


def test_ewma_flags_spike(spark):
    values = [50, 51, 49, 50, 52, 48, 50, 51, 49, 50, 50, 51, 49, 50]
    r = run(spark, values + [300], "ewma", ewma_alpha=0.1)
    assert not r[-2].flag and r[-1].flag and r[-1].score > 0.5


def test_ewma_follows_a_ramp(spark):
    r = run(spark, [201 + i for i in range(60)], "ewma", ewma_alpha=0.2, ewma_warmup=10)
    assert sum(x.flag for x in r) <= 3


def test_warmup_details(spark):
    z = run(spark, NOISE[:5], "zscore")
    assert all(r.detail.warmup and r.detail.z == 0.0 and r.expected == r.value for r in z)
    assert [r.detail.samples for r in z] == [0, 1, 2, 3, 4]
    e = run(spark, NOISE[:5], "ewma")
    assert all(r.detail.warmup and r.detail.z is None for r in e)


@pytest.mark.parametrize("direction", ["up", "down", "both"])
def test_sliced_scalar_detectors_equal_the_sequential_definition(spark, direction):
    rng = random.Random(11)
    values = [rng.choice([0, 0, 5, 6, 7, 8, 9, 30]) if i % 90 > 35 else 4 for i in range(420)]
    cfg = CFG.with_(detectors=("zscore", "ewma"), direction=direction, ewma_alpha=0.4,
                    zscore_window=20, hst_window=20, slice_windows=33)
    rows = score_windows(make_windows(spark, values), cfg).orderBy("window_id").collect()
    recent, mean, var = [], 0.0, 0.0
    for i, (row, v) in enumerate(zip(rows, values)):
        z = zscore_step(recent, float(v), cfg)
        recent = (recent + [float(v)])[-20:]
        e, mean, var = ewma_step(mean, var, i + 1, float(v), cfg)
        for got, want in zip(row.detectors, (z, e)):
            assert got.flag == want["flag"], (i, got, want)
            assert abs(got.score - want["score"]) < 1e-7
            assert abs(got.expected - want["expected"]) < 1e-7
            assert got.detail.warmup == want["detail"]["warmup"]


def test_long_constant_run_inside_ewma_slices(spark):
    values = [100 + (i * 37 % 61) for i in range(100)] + [0] * 900 + [3]
    cfg = CFG.with_(detectors=("ewma",), slice_windows=150, direction="up")
    rows = score_windows(make_windows(spark, values), cfg).orderBy("window_id").collect()
    mean, var = 0.0, 0.0
    for i, v in enumerate(values):
        want, mean, var = ewma_step(mean, var, i + 1, float(v), cfg)
        got = rows[i].detectors[0]
        assert got.flag == want["flag"] and abs(got.score - want["score"]) < 1e-6, i


@pytest.mark.parametrize("changes", [
    {"ewma_alpha": 0.5}, {"ewma_alpha": 0.9}, {"ewma_alpha": 0.96}, {"ewma_alpha": 0.99},
    {"zscore_window": 9000}, {"hst_window": 5000}, {"zscore_window": 8600, "slice_windows": 4000}])
def test_ewma_stays_exact_whatever_other_detectors_need(spark, changes):
    rng = random.Random(3)
    n = 9_500 if changes.get("zscore_window", 0) + changes.get("hst_window", 0) > 1000 else 900
    values = [rng.randint(90, 110) for _ in range(n)]
    cfg = CFG.with_(detectors=("ewma",), **changes)
    rows = score_windows(make_windows(spark, values), cfg).orderBy("window_id").collect()
    mean, var = 0.0, 0.0
    for i, (row, v) in enumerate(zip(rows, values, strict=True)):
        want, mean, var = ewma_step(mean, var, i + 1, float(v), cfg)
        got = row.detectors[0]
        assert got.flag == want["flag"] and abs(got.score - want["score"]) < 1e-6, i
        assert abs(got.expected - want["expected"]) < 1e-6


def test_slices_that_cannot_be_exact_are_rejected():
    with pytest.raises(ValueError):
        CFG.with_(slice_windows=20_000)


def test_trees_sliced_equal_row_by_row(spark):
    rng = random.Random(2)
    values = [rng.randint(0, 20) + (60 if i % 50 == 0 else 0) for i in range(260)]
    cfg = CFG.with_(detectors=("hst",), hst_window=16, hst_trees=5, hst_height=4, hst_warmup=5,
                    zscore_window=10, ewma_alpha=0.9, slice_windows=48)
    rows = score_windows(make_windows(spark, values), cfg).orderBy("window_id").collect()
    dims, cuts = hst.split_table(5, 4, 7)
    lo, hi = np.full(7, np.inf), np.full(7, -np.inf)
    settled, filling, want = None, np.zeros((5, 32)), []
    for i, v in enumerate(values):
        x = np.array([v, v, 0, 0, 0, 0, 0], dtype=float)
        lo, hi = np.minimum(lo, x), np.maximum(hi, x)
        span = np.where(hi > lo, hi - lo, 1.0)
        scaled = np.where(hi > lo, (x - lo) / span, 0.0)
        total = 0.0
        for t in range(5):
            node, dead = 1, False
            for depth in range(5):
                m = settled[t, node] if settled is not None else 0
                if not dead:
                    total += m * 2 ** depth
                dead = dead or m < 1.6
                filling[t, node] += 1
                if depth < 4:
                    node = 2 * node + int(scaled[dims[t, node - 1]] >= cuts[t, node - 1])
        want.append(0.0 if settled is None else 1 - total / (5 * 16 * 31))
        if (i + 1) % 16 == 0:
            settled, filling = filling, np.zeros((5, 32))
    for i, (row, w) in enumerate(zip(rows, want)):
        got = row.detectors[0]
        assert abs(got.score - (0.0 if i < 5 else min(1, max(0, w)))) < 1e-9, i
        assert got.expected == got.value


def test_unavailable_detector_never_flags(spark):
    cfg = CFG.with_(detectors=("zscore", "hst"), unavailable=("hst",))
    r = score_windows(make_windows(spark, NOISE + [900]), cfg).orderBy("window_id").collect()[-1]
    assert r.detectors[0].flag and not r.detectors[1].flag and r.detectors[1].detail.unavailable


def test_custom_detector_joins_the_registry(spark):
    from pyspark.sql import functions as F

    class Cap(detectors.Detector):
        name = "cap"

        def apply(self, frame, cfg):
            x = F.col(cfg.value_metric)
            return frame.withColumn(self.name, detectors.result_struct(
                self.name, x > 150, F.lit(0.95), x, F.lit(150.0)))

    detectors.register(Cap())
    r = run(spark, NOISE + [400], "cap")
    assert r[-1].flag and not r[0].flag
    detectors.REGISTRY.pop("cap")
    with pytest.raises(ValueError, match="unknown detector"):
        detectors.get_detector("cap")


def test_config_from_environment():
    cfg = EngineConfig.from_env({
        "SURGEMARK_TICK_SECONDS": "5", "SURGEMARK_DETECTORS": "zscore, ewma",
        "SURGEMARK_EMIT_OPEN": "false", "SURGEMARK_ZSCORE_WINDOW": "30"})
    assert (cfg.tick_seconds, cfg.detectors, cfg.emit_open, cfg.zscore_window) == (
        5.0, ("zscore", "ewma"), False, 30)
    with pytest.raises(ValueError):
        EngineConfig(direction="sideways")
