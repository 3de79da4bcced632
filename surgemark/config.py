"""Engine parameters. Every operator takes one frozen ``EngineConfig``."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass, fields, replace

# The seven named scalars every window carries, and the dimensions
# tracked by default.
FEATURES = (
    "rate", "count", "distinct_subjects", "distinct_actors",
    "bot_ratio", "bytes_per_sec", "new_rate",
)
TRACKED_DIMS = ("domain", "lang", "kind", "namespace", "user_type")

ENV_PREFIX = "SURGEMARK_"


@dataclass(frozen=True)
class EngineConfig:
    # windowing
    tick_seconds: float = 1.0
    primary_metric: str = "rate"
    track_dims: tuple[str, ...] = TRACKED_DIMS
    dim_topk: int = 15
    late: str = "event_time"            # "event_time" | "fold"
    emit_open: bool = True              # treat the end of a batch as closing the last window

    # rolling z-score
    zscore_window: int = 60
    zscore_threshold: float = 3.2
    zscore_min_samples: int = 12

    # EWMA chart
    ewma_alpha: float = 0.08
    ewma_threshold: float = 3.2
    ewma_warmup: int = 12

    # half-space trees
    hst_threshold: float = 0.85
    hst_warmup: int = 50
    hst_trees: int = 25
    hst_height: int = 8
    hst_window: int = 120
    hst_seed: int = 7

    direction: str = "up"               # "up" | "down" | "both"
    detectors: tuple[str, ...] = ("zscore", "ewma", "hst")
    unavailable: tuple[str, ...] = ()   # listed in results, never flagged, not counted

    # decaying baselines and the "why" breakdown
    baseline_alpha: float = 0.05
    baseline_prune: float = 0.05
    why_top_n: int = 6
    why_min_excess: float = 1.0

    # ensemble
    min_confidence: float = 0.5
    strong_single: float = 0.92
    warn_at: float = 0.65
    critical_at: float = 0.85
    cooldown_seconds: float = 4.0

    # history
    incident_pad: float = 60.0
    history_default: int = 900
    history_max: int = 86_400
    metric_buffer: int = 900
    anomaly_buffer: int = 200
    retention_days: int = 7

    # ingest
    max_events_per_sec: int = 0         # 0 = no cap
    source: str = "recentchange"

    # plan shape
    slice_windows: int = 0              # windows per time slice; 0 = derived from alpha

    def __post_init__(self) -> None:
        if self.tick_us <= 0:
            raise ValueError("tick_seconds must be at least one microsecond")
        if not 0.0 < self.ewma_alpha < 1.0:
            raise ValueError("ewma_alpha must lie strictly between 0 and 1")
        if not 0.0 < self.baseline_alpha < 1.0:
            raise ValueError("baseline_alpha must lie strictly between 0 and 1")
        if self.slice_windows and not 0 < self.slice_windows <= self.ewma_rows - self.ewma_halo:
            raise ValueError(
                f"slice_windows must lie between 1 and {self.ewma_rows - self.ewma_halo} for this ewma_alpha")
        if self.direction not in ("up", "down", "both"):
            raise ValueError(f"unknown direction {self.direction!r}")
        if self.late not in ("event_time", "fold"):
            raise ValueError(f"unknown late policy {self.late!r}")

    # -- derived -------------------------------------------------------------

    @property
    def tick_us(self) -> int:
        return int(round(self.tick_seconds * 1_000_000))

    @property
    def value_metric(self) -> str:
        """Metric the scalar detectors read; unknown names fall back to the rate."""
        return self.primary_metric if self.primary_metric in FEATURES else "rate"

    @property
    def ewma_halo(self) -> int:
        """Rows after which a forgotten EWMA prefix weighs less than 1e-50."""
        return math.ceil(50 / -math.log10(1.0 - self.ewma_alpha))

    @property
    def baseline_halo(self) -> int:
        return math.ceil(50 / -math.log10(1.0 - self.baseline_alpha))

    @property
    def halo(self) -> int:
        """History rows each slice repeats so that every detector is exact inside it."""
        return max(self.zscore_window, self.ewma_halo, 2 * self.hst_window)

    @property
    def slice_len(self) -> int:
        """Windows per slice: (1-alpha)^-rows, counted from the EWMA halo on, stays below
        1e230. Other detectors' halos do not count: EWMA gives their rows no weight."""
        return self.slice_windows or min(65_536, self.ewma_rows - self.ewma_halo)

    @property
    def ewma_rows(self) -> int:
        """Rows after which (1-alpha)^-rows reaches 1e230; over four times the EWMA halo."""
        return int(230 / -math.log10(1.0 - self.ewma_alpha))

    def with_(self, **changes) -> "EngineConfig":
        return replace(self, **changes)

    @classmethod
    def from_env(cls, environ=None) -> "EngineConfig":
        """Defaults overridden by ``SURGEMARK_<FIELD>`` variables."""
        environ = os.environ if environ is None else environ
        found = {}
        for f in fields(cls):
            raw = environ.get(ENV_PREFIX + f.name.upper())
            if raw is None:
                continue
            default = f.default
            if isinstance(default, bool):
                found[f.name] = raw.strip().lower() in ("1", "true", "yes", "on")
            elif isinstance(default, tuple):
                found[f.name] = tuple(p.strip() for p in raw.split(",") if p.strip())
            else:
                found[f.name] = type(default)(raw)
        return cls(**found)
