"""Blend detector results into candidates, apply the cooldown, build anomaly records."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from surgemark.config import EngineConfig
from surgemark.functions.scalar import half_up

COOLDOWN_CHUNK = 256


def collect_results(results: DataFrame, order: tuple[str, ...] = ("zscore", "ewma", "hst")) -> DataFrame:
    """Long results (one row per window and detector) to one row per window."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in order]), F.col("name")), F.lit(0))
    rank = F.when(rank == 0, F.lit(len(order) + 1)).otherwise(rank)
    packed = F.struct(
        rank.alias("_rank"), "name", "flag", "score", F.col("value"), "expected", "detail"
    )
    keys = [c for c in results.columns if c not in
            ("name", "flag", "score", "value", "expected", "detail")]
    rows = results.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias("detectors"))
    return rows.withColumn(
        "detectors",
        F.transform("detectors", lambda r: F.struct(
            *[r[c].alias(c) for c in ("name", "flag", "score", "value", "expected", "detail")])),
    ).withColumn("value", F.col("detectors")[0]["value"])


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, v: acc + v)


def severity(score: Column, fired: Column, available: Column, cfg: EngineConfig) -> Column:
    """Full agreement of at least two detectors lifts the level one step."""
    full = (available >= 2) & (fired == available)
    return (
        F.when((score >= cfg.critical_at) | (full & (score >= cfg.warn_at)), "critical")
        .when((score >= cfg.warn_at) | full, "warn")
        .otherwise("info")
    )


def ensemble(frame: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Windows whose detectors agree strongly enough, before any cooldown.

    Expects ``detectors`` (array of results), ``value`` and window bounds. Confidence is
    the fired scores summed over the number of *available* detectors.
    """
    live = F.filter("detectors", lambda d: ~F.coalesce(d["detail"]["unavailable"], F.lit(False)))
    hits = F.filter(live, lambda d: d["flag"])
    quiet_dropped = (
        frame.where("fired").drop("fired") if "fired" in frame.columns
        else frame.where(F.exists("detectors", lambda d: d["flag"]))
    )
    scored = (
        quiet_dropped
        .withColumn("_live", F.size(live))
        .withColumn("_hits", hits)
        .where((F.col("_live") > 0) & (F.size("_hits") > 0))
        .withColumn("agreement", F.size("_hits"))
        .withColumn(
            "confidence",
            F.least(F.lit(1.0), _total(F.transform("_hits", lambda d: d["score"])) / F.col("_live")),
        )
        .withColumn("max_fired", F.array_max(F.transform("_hits", lambda d: d["score"])))
        .where(
            (F.col("confidence") >= cfg.min_confidence)
            | (F.col("max_fired") >= cfg.strong_single)
        )
    )
    known = F.filter("_hits", lambda d: d["expected"].isNotNull())
    boosted = (F.col("max_fired") >= cfg.strong_single) & (F.col("agreement") >= 2)
    return (
        scored.withColumn(
            "expected",
            F.when(F.size(known) > 0,
                   _total(F.transform(known, lambda d: d["expected"])) / F.size(known))
            .otherwise(F.col("value")),
        )
        .withColumn(
            "raw_score",
            F.when(boosted, F.least(F.lit(1.0), F.col("confidence") + 0.05))
            .otherwise(F.col("confidence")),
        )
        .withColumn("severity", severity(F.col("raw_score"), F.col("agreement"), F.col("_live"), cfg))
        .withColumn("score", half_up(F.col("raw_score"), 4))
        .withColumnRenamed("_live", "available")
        .drop("_hits")
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of a sorted stream that agree in their first ``keys`` columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _following(at: np.ndarray, cd: float) -> np.ndarray:
    """For each time the place of the first one at least ``cd`` later."""
    found = np.searchsorted(at, at + cd)
    late = (found > 0) & (at[found - 1] - at >= cd)          # the sum above was rounded up
    found = np.where(late, found - 1, found)
    early = (found < len(at)) & (at[np.minimum(found, len(at) - 1)] - at < cd)
    return np.where(early, found + 1, found)


def apply_cooldown(
    candidates: DataFrame, cfg: EngineConfig, ts: str = "window_end",
    keys: tuple[str, ...] = ("series", "metric"), chunk_spans: int = COOLDOWN_CHUNK,
) -> DataFrame:
    """Drop a candidate closer than the cooldown to the last *emitted* one.

    Time is cut into chunks of ``chunk_spans`` cooldowns. What a chunk emits depends on the
    past only through its first emission, which must lie in its first cooldown or be the
    first candidate after that; for each of these few the chunk's last emission is found.
    Going through these rows in order with one number of state, the last emission so far,
    gives each chunk's first emission, and the chunks then emit independently.
    """
    cd = float(cfg.cooldown_seconds)
    if cd <= 0:
        return candidates
    keys = list(keys)
    width = cd * chunk_spans
    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema.fields}
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    n = len(keys)
    slim = (
        candidates.select(*keys, F.floor(F.col(ts).cast("double") / F.lit(width)).alias("_chunk"),
                          F.col(ts).cast("double").alias("_at"))
        .where("_at IS NOT NULL").distinct()
    )

    def batch(rows: list[tuple], names: list[str], like: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), like)], names=names)

    key_types = [to_arrow_type(candidates.schema[k].dataType) for k in keys]
    whole, real = pa.int64(), pa.float64()

    def transfers(batches):
        for key, rows in _groups(batches, n + 1):
            at = np.array([r[0] for r in rows])
            step = _following(at, cd)
            last = np.arange(len(at))
            for i in range(len(at) - 1, -1, -1):
                if step[i] < len(at):
                    last[i] = last[step[i]]
            reach = min(len(at), int(np.searchsorted(at, key[n] * width + cd)) + 1)
            yield batch([(*key, float(at[i]), float(at[last[i]])) for i in range(reach)],
                        [*keys, "_chunk", "_at", "_last"], [*key_types, whole, real, real])

    def entries(batches):
        key, last, entered = None, -np.inf, None
        for part in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:n] != key:
                    key, last, entered = row[:n], -np.inf, None
                if row[n] != entered and row[n + 1] - last >= cd:
                    entered, last = row[n], row[n + 2]
                    out.append(row[:n + 2])
            if out:
                yield batch(out, [*keys, "_chunk", "_entry"], [*key_types, whole, real])

    def emissions(batches):
        for key, rows in _groups(batches, n + 1):
            at = np.array([r[0] for r in rows])
            step = _following(at, cd)
            i, out = int(np.searchsorted(at, rows[0][1])), []
            while i < len(at):
                out.append((*key[:n], float(at[i])))
                i = int(step[i])
            if out:
                yield batch(out, [*keys, "_at"], [*key_types, real])

    chunked = slim.repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", "_at")
    first = (
        chunked.mapInArrow(transfers, f"{head}, _chunk long, _at double, _last double")
        .repartition(*keys).sortWithinPartitions(*keys, "_chunk", "_at")
        .mapInArrow(entries, f"{head}, _chunk long, _entry double")
    )
    emitted = (
        slim.join(first, [*keys, "_chunk"]).select(*keys, "_chunk", "_at", "_entry")
        .repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", "_at")
        .mapInArrow(emissions, f"{head}, _at double")
    )
    return (
        candidates.withColumn("_at", F.col(ts).cast("double"))
        .join(emitted, on=[*keys, "_at"], how="left_semi")
        .drop("_at")
    )


def anomaly_id() -> Column:
    """12 hex digits derived from what the anomaly is about, so re-runs agree."""
    text = F.concat_ws("|", "series", "metric", F.col("window_id").cast("string"))
    return F.substring(F.sha2(text, 256), 1, 12)


ANOMALY_COLUMNS = (
    "id", "ts", "series", "metric", "value", "expected", "severity", "score",
    "agreement", "available", "detectors", "window_id", "window_start", "window_end",
)


def anomaly_records(surfaced: DataFrame) -> DataFrame:
    return (
        surfaced.withColumn("id", anomaly_id())
        .withColumn("ts", F.col("window_end"))
        .select(*ANOMALY_COLUMNS)
    )
