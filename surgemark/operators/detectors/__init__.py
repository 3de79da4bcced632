"""Detector registry. A detector adds one result struct, named after itself."""

from surgemark.operators.detectors.base import Detector, result_struct
from surgemark.operators.detectors.ewma import EwmaChart
from surgemark.operators.detectors.hst import HalfSpaceTrees
from surgemark.operators.detectors.zscore import RollingZScore

REGISTRY: dict[str, Detector] = {d.name: d for d in (RollingZScore(), EwmaChart(), HalfSpaceTrees())}


def register(detector: Detector) -> None:
    """Make a further detector available to ``EngineConfig.detectors``."""
    REGISTRY[detector.name] = detector


def get_detector(name: str) -> Detector:
    if name not in REGISTRY:
        raise ValueError(f"unknown detector {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[name]


__all__ = [
    "Detector", "EwmaChart", "HalfSpaceTrees", "REGISTRY", "RollingZScore",
    "get_detector", "register", "result_struct",
]
