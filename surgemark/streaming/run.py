"""Streaming end to end: scored windows to the metric and anomaly tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from surgemark.config import EngineConfig
from surgemark.functions.scalar import from_epoch
from surgemark.operators.ensemble import anomaly_records, apply_cooldown, ensemble
from surgemark.operators.explain import contributions
from surgemark.operators.history import anomaly_table, metric_table, write_once, written_before
from surgemark.operators.windows import derived_columns
from surgemark.plans.detection import attach_why
from surgemark.sources.arrival import stream_lines
from surgemark.sources.jsonl import parse_recorded
from surgemark.streaming.closing import closed_windows, configure, fold_stream, read_closed
from surgemark.streaming.scoring import score_stream

QUERY_ID = "sql.streaming.queryId"       # fixed value: the local property with a stream's own id


def read_recorded_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Recorded JSON lines as an event stream, ``seq`` in order of arrival.

    Each micro-batch takes the files that have come since the last one; see
    ``sources.arrival`` for their order and for ``options``.
    """
    return parse_recorded(stream_lines(spark, path, **options).where(F.trim("value") != ""))


def decode_stream(messages: DataFrame, payload: str = "d", seq: str = "offset") -> DataFrame:
    """Events from a message stream (for example a Kafka ``value`` column)."""
    rows = messages.select(
        F.col(payload).cast("string").alias(payload), F.col(seq).cast("long").alias("seq"))
    return parse_recorded(rows, payload)


def scored_view(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Scored rows with the derived metrics the batch plan has."""
    return rows.select(
        "*", *derived_columns(cfg), F.lit(cfg.primary_metric).alias("metric"),
    ).withColumn("value", F.col(cfg.value_metric).cast("double"))


def emit_anomalies(scored: DataFrame, stored: DataFrame | None, cfg: EngineConfig) -> DataFrame:
    """Anomalies of one micro-batch, given the ones already stored.

    Stored anomalies younger than the cooldown are re-run in front of the new candidates,
    so the cooldown spans batches without any state of its own.
    """
    candidates = ensemble(scored.drop("sightings"), cfg)
    names = ["series", "metric", "window_end"]
    pool = candidates.select(*names)
    if stored is not None:
        first = candidates.agg(F.min("window_end").alias("t")).scalar()
        since = from_epoch(first - F.lit(float(cfg.cooldown_seconds)))
        recent = stored.where((F.col("day") >= F.to_date(since)) & (F.col("time") >= since))
        pool = pool.unionByName(recent.select(*names)).distinct()
    kept = candidates.join(apply_cooldown(pool, cfg), names, "left_semi")
    surfaced = anomaly_records(kept)
    levels = scored.select("series", "window_id", F.inline("sightings")).join(
        surfaced.select("series", "window_id"), ["series", "window_id"], "left_semi")
    return attach_why(surfaced, contributions(levels, cfg))


def write_batch(
    rows: DataFrame, batch_id: int, path: str, cfg: EngineConfig,
    on_metric: Callable[[DataFrame], None] | None = None,
    on_anomaly: Callable[[DataFrame], None] | None = None,
    run: str = "stream",
) -> None:
    """Both outputs of a tick, each in folders of this run and batch.

    A batch repeated after a failure, also one between the two tables, replaces its own rows
    and sees the anomalies as they were before it, so it comes to the same result.
    """
    spark = rows.sparkSession
    held = rows.persist()
    try:
        scored = scored_view(held, cfg)
        metrics = metric_table(scored)
        write_once(metrics, f"{path}/metrics", run, batch_id)
        stored = written_before(spark, f"{path}/anomalies", run, batch_id)
        found = anomaly_table(emit_anomalies(scored, stored, cfg))
        if on_anomaly is not None:
            found = found.persist()
        write_once(found, f"{path}/anomalies", run, batch_id)
        if on_metric is not None:
            on_metric(metrics)
        if on_anomaly is not None:
            on_anomaly(found)
    finally:
        held.unpersist()


def stream_scored(
    scored: DataFrame, path: str, checkpoint: str, cfg: EngineConfig, on_metric=None,
    on_anomaly=None, run: str | None = None, **trigger,
) -> StreamingQuery:
    """``run`` names the rows of this stream in the tables; by default it is the query's id,
    which lives as long as its checkpoint."""
    def write(df: DataFrame, n: int) -> None:
        own = run or df.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        write_batch(df, n, path, cfg, on_metric, on_anomaly, own)

    return (
        scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def stream_anomalies(
    events: DataFrame, path: str, checkpoint: str, cfg: EngineConfig,
    series_cols: Sequence[str] = (), delay: str = "0 seconds", idle: bool = False,
    on_metric=None, on_anomaly=None, initial: DataFrame | None = None, **trigger,
) -> StreamingQuery:
    """Event stream to stored metrics and anomalies, under the late policy of ``cfg``.

    With ``late="fold"`` no event is dropped: a first query closes windows by arrival, and
    the scorer follows the windows it has written. Under ``event_time`` events later than
    ``delay`` are dropped by the watermark. ``initial`` is the state that a batch run over
    the history left (``handover.scorer_state``); the events then start after that history.
    """
    configure(events.sparkSession)
    if cfg.late == "fold":
        folding = fold_stream(events, f"{path}/fold", f"{checkpoint}/fold", cfg, series_cols, **trigger)
        if not trigger or "availableNow" in trigger:
            folding.awaitTermination()
        return stream_scored(
            score_stream(read_closed(events.sparkSession, f"{path}/fold"), cfg, initial=initial), path,
            f"{checkpoint}/score", cfg,
            on_metric, on_anomaly, **trigger)
    closed = closed_windows(events, cfg, series_cols, delay)
    return stream_scored(
        score_stream(closed, cfg, idle, initial), path, checkpoint, cfg, on_metric, on_anomaly, **trigger)


class BatchDurations(StreamingQueryListener):
    """Collects one (epoch seconds, batch seconds) pair per micro-batch for the p95 panel.

    Only progress summaries reach the driver. With a ``path`` every ``keep`` pairs are
    appended to a table there, so a query that runs for years holds no more; no pair is lost.
    """

    def __init__(self, path: str | None = None, keep: int = 1_000) -> None:
        self.rows, self.path, self.keep = [], path, keep

    def _table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), "at double, seconds double")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        from datetime import datetime

        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp()
        self.rows.append((at, p.batchDuration / 1000.0))
        if self.path is not None and len(self.rows) >= self.keep:
            self._table(SparkSession.active()).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        held = self._table(spark)
        try:
            return held if self.path is None else held.unionByName(spark.read.parquet(self.path))
        except AnalysisException:         # nothing written yet
            return held
