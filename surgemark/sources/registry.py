"""Named sources: how to read a location and how to normalise what was read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from surgemark.sources.capture import read_capture
from surgemark.sources.jsonl import read_recording
from surgemark.sources.recentchange import normalise_recentchange
from surgemark.sources.tables import normalise_events, normalise_orders


@dataclass(frozen=True)
class Source:
    name: str
    default_path: str
    read: Callable[[SparkSession, str], DataFrame]
    normalise: Callable[[DataFrame], DataFrame]


REGISTRY: dict[str, Source] = {}


def register_source(source: Source) -> None:
    REGISTRY[source.name] = source


def get_source(name: str) -> Source:
    if name not in REGISTRY:
        raise ValueError(f"unknown source {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[name]


def read_events(spark: SparkSession, source: str, path: str | None = None) -> DataFrame:
    """Canonical events of a registered source."""
    spec = get_source(source)
    return spec.normalise(spec.read(spark, path or spec.default_path))


def _captured_payloads(spark: SparkSession, path: str) -> DataFrame:
    return read_capture(spark, path).select(F.col("data").alias("value"))


register_source(Source(
    "recentchange", "recentchange", lambda spark, path: spark.read.text(path),
    normalise_recentchange,
))
register_source(Source("capture", "capture", _captured_payloads, normalise_recentchange))
register_source(Source(
    "events", "events.parquet", lambda spark, path: spark.read.parquet(path), normalise_events,
))
register_source(Source(
    "orders", "orders.parquet", lambda spark, path: spark.read.parquet(path), normalise_orders,
))
register_source(Source("jsonl", "events.jsonl", read_recording, lambda df: df))
