"""Streaming stage 2: closed windows to scored windows, one small state per series.

Each series keeps the z-score buffer, two EWMA numbers, the tree masses of two blocks and
one level per dimension value. Input is one row per window, never raw events.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from surgemark.config import FEATURES, EngineConfig
from surgemark.operators.detectors.base import FLAT_SCORE, FLAT_STD, ROUNDING
from surgemark.operators.detectors.hst import masses, node_paths, score_rows, split_table
from surgemark.operators.windows import COUNTS
from surgemark.schemas import RESULT

SWEEP_EVERY = 4_096
BLOCK = 4_096                 # windows scored and emitted at a time, however long a gap is

STATE = T.StructType([
    T.StructField("lo", T.LongType()), T.StructField("last", T.LongType()),
    T.StructField("recent", T.ArrayType(T.DoubleType())),
    T.StructField("mean", T.DoubleType()), T.StructField("var", T.DoubleType()),
    T.StructField("low", T.ArrayType(T.DoubleType())), T.StructField("high", T.ArrayType(T.DoubleType())),
    T.StructField("filling", T.ArrayType(T.LongType())), T.StructField("settled", T.ArrayType(T.LongType())),
    T.StructField("swept", T.LongType()),
])
SIGHTING = "struct<dim:string,value:string,cnt:bigint,rk:int,baseline:double>"
OUTPUT = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("window_id", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in COUNTS],
    T.StructField("detectors", T.ArrayType(RESULT)),
    T.StructField("sightings", T.ArrayType(T.StructType([
        T.StructField("dim", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("cnt", T.LongType()), T.StructField("rk", T.IntegerType()),
        T.StructField("baseline", T.DoubleType()),
    ]))),
])
DETAIL_NAMES = ("z", "std", "mean", "samples", "raw_score", "warmup", "unavailable")


def _round(x: float, digits: int) -> float:
    return math.floor(x * 10 ** digits + 0.5) / 10 ** digits


def _result(name: str, flag: bool, score: float, value: float, expected: float, **detail) -> dict:
    return {
        "name": name, "flag": bool(flag), "score": min(1.0, max(0.0, score)), "value": value,
        "expected": expected, "detail": {n: detail.get(n) for n in DETAIL_NAMES},
    }


def _as(kind: T.DataType, x):
    """A state field from pandas, which turns integers beside nulls into floats."""
    if isinstance(kind, T.ArrayType):
        return [_as(kind.elementType, v) for v in x]
    return int(x) if isinstance(kind, T.LongType) else float(x)


def sigma_step(delta: float, std: float, threshold: float, direction: str) -> tuple[bool, float, float]:
    """(flag, score, z) of one value; the scalar twin of ``sigma_verdict``."""
    towards = {"up": delta > 0, "down": delta < 0, "both": True}[direction]
    if std < FLAT_STD:
        hit = abs(delta) > FLAT_STD and towards
        return hit, FLAT_SCORE if hit else 0.0, 0.0
    z = delta / std
    score = 1.0 / (1.0 + math.exp(min(700.0, threshold - abs(z)))) if towards else 0.0
    return towards and abs(z) >= threshold, score, z


def zscore_step(recent: list[float], x: float, cfg: EngineConfig) -> dict:
    n = len(recent)
    if n < cfg.zscore_min_samples:
        return _result("zscore", False, 0.0, x, x, z=0.0, warmup=True, samples=n)
    mean = sum(recent) / n
    std = math.sqrt(sum((v - mean) ** 2 for v in recent) / (n - 1))
    delta = 0.0 if abs(x - mean) <= ROUNDING * abs(x) else x - mean
    flag, score, z = sigma_step(delta, std, cfg.zscore_threshold, cfg.direction)
    if std < FLAT_STD:
        return _result("zscore", flag, score, x, mean, z=0.0, std=0.0, mean=mean)
    return _result("zscore", flag, score, x, mean, z=_round(z, 3), std=_round(std, 4), mean=_round(mean, 4))


def ewma_step(mean: float, var: float, n: int, x: float, cfg: EngineConfig) -> tuple[dict, float, float]:
    """Judge the n-th value (1-based) and return the next (mean, var)."""
    if n == 1:
        return _result("ewma", False, 0.0, x, x, warmup=True), x, 0.0
    a = cfg.ewma_alpha
    following = (mean + a * (x - mean), (1 - a) * (var + a * (x - mean) ** 2))
    if n <= cfg.ewma_warmup:
        return (_result("ewma", False, 0.0, x, mean, warmup=True, mean=_round(mean, 4)), *following)
    delta = 0.0 if abs(x - mean) <= ROUNDING * abs(x) else x - mean
    std = math.sqrt(var)
    flag, score, z = sigma_step(delta, std, cfg.ewma_threshold, cfg.direction)
    shown = {"z": 0.0} if std < FLAT_STD else {"z": _round(z, 3), "std": _round(std, 4)}
    return (_result("ewma", flag, score, x, mean, mean=_round(mean, 4), **shown), *following)


def baseline_step(level: float, gap: int, count: int, cfg: EngineConfig) -> tuple[float, float]:
    """(level before this sighting, level after) with ``gap`` unseen windows between."""
    keep = 1.0 - cfg.baseline_alpha
    before = level * keep ** gap if gap else level
    if gap and before < cfg.baseline_prune:
        before = 0.0
    return before, keep * before + cfg.baseline_alpha * count


class WindowScorer(StatefulProcessor):
    def __init__(self, cfg: EngineConfig, idle: bool = True) -> None:
        self.cfg, self.idle = cfg, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trees = split_table(self.cfg.hst_trees, self.cfg.hst_height, self.cfg.hst_seed)
        self.core = handle.getValueState("core", STATE)
        self.levels = handle.getMapState(
            "levels", "dim string, value string", "level double, last bigint")

    # -- state -------------------------------------------------------------------

    def _load(self) -> dict | None:
        row = self.core.get() if self.core.exists() else None
        return None if row is None else dict(zip(STATE.fieldNames(), row))

    def _start(self, window: int) -> dict:
        nodes = self.cfg.hst_trees * 2 ** (self.cfg.hst_height + 1)
        return {
            "lo": window, "last": window - 1, "recent": [], "mean": 0.0, "var": 0.0,
            "low": [math.inf] * len(FEATURES), "high": [-math.inf] * len(FEATURES),
            "filling": [0] * nodes, "settled": [], "swept": window,
        }

    def _sweep(self, s: dict) -> None:
        """Forget values that have decayed under the prune level while unseen."""
        keep = 1.0 - self.cfg.baseline_alpha
        gone = [
            key for key, (level, last) in self.levels.iterator()
            if s["last"] > last and level * keep ** (s["last"] - last) < self.cfg.baseline_prune
        ]
        for key in gone:
            self.levels.removeKey(key)
        s["swept"] = s["last"]

    # -- work ----------------------------------------------------------------------

    def _trees(self, s: dict, features: np.ndarray) -> list[float]:
        """Raw tree scores of the next rows; block masses roll over inside ``s``."""
        cfg = self.cfg
        dims, cuts = self.trees
        lo = np.minimum(np.minimum.accumulate(features, axis=0), np.array(s["low"]))
        hi = np.maximum(np.maximum.accumulate(features, axis=0), np.array(s["high"]))
        s["low"], s["high"] = lo[-1].tolist(), hi[-1].tolist()
        span = hi - lo
        x = np.where(span > 0, (features - lo) / np.where(span > 0, span, 1.0), 0.0)
        shape = (cfg.hst_trees, 2 ** (cfg.hst_height + 1))
        filling = np.array(s["filling"], dtype=np.int64).reshape(shape)
        settled = np.array(s["settled"], dtype=np.int64).reshape(shape) if s["settled"] else None
        out, at, row = [], 0, s["last"] + 1 - s["lo"]
        while at < len(x):
            take = min(len(x) - at, cfg.hst_window - row % cfg.hst_window)
            path = node_paths(x[at:at + take], dims, cuts, cfg.hst_height)
            out += (
                [0.0] * take if settled is None
                else score_rows(path, settled, cfg.hst_window, cfg.hst_height).tolist()
            )
            filling = filling + masses(path, cfg.hst_height)
            at, row = at + take, row + take
            if row % cfg.hst_window == 0:
                settled, filling = filling, np.zeros(shape, dtype=np.int64)
        s["filling"] = filling.ravel().tolist()
        s["settled"] = [] if settled is None else settled.ravel().tolist()
        return out

    def _features(self, counts: dict) -> list[float]:
        tick, n = float(self.cfg.tick_seconds), counts["count"]
        return [
            n / tick, float(n), float(counts["distinct_subjects"]), float(counts["distinct_actors"]),
            counts["bot_count"] / n if n else 0.0, counts["bytes_changed"] / tick,
            counts["new_count"] / tick,
        ]

    def _score(self, series: str, s: dict, windows: list[dict]) -> pd.DataFrame:
        """Score gap-free ``windows`` that continue the series."""
        cfg = self.cfg
        features = np.array([self._features(w) for w in windows])
        live = [d for d in cfg.detectors if d not in cfg.unavailable]
        raw = self._trees(s, features) if "hst" in live else [0.0] * len(windows)
        column = FEATURES.index(cfg.value_metric)
        cache: dict[tuple[str, str], tuple[float, int]] = {}
        rows = []
        for w, vector, tree in zip(windows, features.tolist(), raw):
            x, n = vector[column], w["window_id"] - s["lo"] + 1
            results = {"zscore": zscore_step(s["recent"], x, cfg)}
            s["recent"] = (s["recent"] + [x])[-cfg.zscore_window:]
            results["ewma"], s["mean"], s["var"] = ewma_step(s["mean"], s["var"], n, x, cfg)
            warm = n <= cfg.hst_warmup
            results["hst"] = _result(
                "hst", not warm and tree >= cfg.hst_threshold, 0.0 if warm else tree, x, x,
                raw_score=_round(tree, 4), warmup=True if warm else None)
            sightings = []
            for d in w["dims"]:
                key = (d["dim"], d["value"])
                if key not in cache:
                    cache[key] = self.levels.getValue(key) if self.levels.containsKey(key) else (0.0, w["window_id"] - 1)
                level, last = cache[key]
                before, after = baseline_step(level, w["window_id"] - last - 1, d["cnt"], cfg)
                cache[key] = (after, w["window_id"])
                sightings.append({**d, "baseline": before})
            rows.append({
                "series": series, "window_id": w["window_id"], **{c: w[c] for c in COUNTS},
                "detectors": [
                    results[d] if d in live else _result(d, False, 0.0, x, x, unavailable=True)
                    for d in cfg.detectors
                ],
                "sightings": sightings,
            })
            s["last"] = w["window_id"]
        for key, value in cache.items():
            self.levels.updateValue(key, value)
        if s["last"] - s["swept"] >= SWEEP_EVERY:
            self._sweep(s)
        return pd.DataFrame(rows, columns=OUTPUT.fieldNames())

    def _empty(self, window: int) -> dict:
        return {"window_id": window, **{c: 0 for c in COUNTS}, "dims": []}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = {}
        for pdf in rows:
            for r in pdf.to_dict("records"):
                arrived[int(r["window_id"])] = {
                    "window_id": int(r["window_id"]), **{c: int(r[c]) for c in COUNTS},
                    "dims": [{"dim": d["dim"], "value": d["value"], "cnt": int(d["cnt"]), "rk": int(d["rk"])}
                             for d in r["dims"]],
                }
        s = self._load() or self._start(min(arrived))
        upto = max(arrived)
        if upto > s["last"]:
            yield from self._advance(key[0], s, upto, arrived)

    def _advance(self, series: str, s: dict, upto: int, arrived: dict) -> Iterator[pd.DataFrame]:
        """Score up to window ``upto``, empty where nothing arrived, a block at a time."""
        while s["last"] < upto:
            span = range(s["last"] + 1, min(upto, s["last"] + BLOCK) + 1)
            yield self._score(series, s, [arrived.get(w) or self._empty(w) for w in span])
        self.core.update(tuple(s[n] for n in STATE.fieldNames()))
        self._arm(s)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Take over what ``handover.scorer_state`` left; its rows come in any order and cut."""
        for r in initialState.to_dict("records"):
            if pd.isna(r["dim"]):
                s = {f.name: _as(f.dataType, r["core"][f.name]) for f in STATE.fields}
                self.core.update(tuple(s[n] for n in STATE.fieldNames()))
                self._arm(s)
            else:
                self.levels.updateValue((r["dim"], r["value"]), (float(r["level"]), int(r["last"])))

    def _arm(self, s: dict) -> None:
        if self.idle:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(int((s["last"] + 2) * self.cfg.tick_us // 1000) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The clock passed the end of the next window and nothing came: emit empty ones."""
        s = self._load()
        closed = timerValues.getCurrentWatermarkInMs() * 1000 // self.cfg.tick_us - 1
        if s is not None and closed > s["last"]:
            yield from self._advance(key[0], s, closed, {})

    def close(self) -> None:
        pass


def score_stream(
    closed: DataFrame, cfg: EngineConfig, idle: bool = False, initial: DataFrame | None = None,
) -> DataFrame:
    """Gap-free scored windows. ``idle`` also closes empty windows of quiet series as the
    watermark passes them; it needs a watermarked input. ``initial`` is the state to go on
    from (``handover.scorer_state``); windows at or before its last one are left out."""
    keyed = closed.select("series", "window_id", *COUNTS, "dims",
                          *(["closed_at"] if idle else [])).groupBy("series")
    return keyed.transformWithStateInPandas(
        statefulProcessor=WindowScorer(cfg, idle), outputStructType=OUTPUT, outputMode="Append",
        timeMode="EventTime" if idle else "None",
        initialState=None if initial is None else initial.groupBy("series"),
    )
