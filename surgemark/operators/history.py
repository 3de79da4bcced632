"""Stored tables and the queries over them: recent rows, incidents, retention."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import epoch, from_epoch, half_up
from surgemark.operators.frames import FRAME_DIMS, FRAME_TOP, leading_values
from surgemark.schemas import ANOMALY_TABLE, METRIC_TABLE


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def metric_table(
    scored: DataFrame, source: str | None = None, nested_dims: DataFrame | None = None
) -> DataFrame:
    """Scored windows in stored form; a missing source gets the default name.

    ``top`` holds the leading dimension values, from ``nested_dims`` (``nest_dims``) or from
    the ``sightings`` that streaming rows carry; it is null where neither is known.
    """
    rows = scored.withColumn("time", from_epoch(F.col("window_end"))).withColumn(
        "source", F.lit(source or EngineConfig().source))
    if nested_dims is not None:
        rows = rows.join(nested_dims, ["series", "window_id"], "left").withColumn(
            "top", leading_values(F.col("dim_counts")))
    elif "sightings" in rows.columns:
        rows = rows.withColumn("top", _seen_values(F.col("sightings")))
    else:
        rows = rows.withColumn("top", F.lit(None))
    return _conform(rows, METRIC_TABLE)


def _seen_values(sightings: Column) -> Column:
    """Streaming sightings of a dimension come in rank order."""
    def of(dim: str) -> Column:
        mine = F.filter(sightings, lambda s: s["dim"] == dim)
        return F.slice(
            F.transform(mine, lambda s: F.struct(s["value"].alias("value"), s["cnt"].alias("cnt"))), 1, FRAME_TOP)

    pairs = F.array(*[F.struct(F.lit(d).alias("key"), of(d).alias("value")) for d in FRAME_DIMS])
    return F.map_from_entries(F.filter(pairs, lambda p: F.size(p["value"]) > 0))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A stored metric table with the window end in epoch seconds, as the queries below read it."""
    stored = spark.read.option("ignoreMissingFiles", True).parquet(path)
    return stored.withColumn("window_end", epoch(F.col("time")))


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """A stored anomaly table with its time in epoch seconds (``ts``)."""
    return spark.read.parquet(path).withColumn("ts", epoch(F.col("time")))


def anomaly_table(anomalies: DataFrame) -> DataFrame:
    return _conform(anomalies.withColumn("time", from_epoch(F.col("ts"))), ANOMALY_TABLE)


# -- sinks -----------------------------------------------------------------------


def append_by_day(df: DataFrame, path: str, time: str = "time") -> None:
    """Append to a table partitioned by UTC day; one shuffle keeps files per day few."""
    (
        df.withColumn("day", F.to_date(time))
        .repartition("day")
        .write.mode("append").partitionBy("day").parquet(path)
    )


def new_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet, one per key; missing parts of a key are equal."""
    stored = existing.select(*[F.col(k).alias(f"_stored_{k}") for k in keys]).distinct()
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys])
    return new.dropDuplicates(list(keys)).join(stored, same, "left_anti")


def append_idempotent(
    new: DataFrame, path: str, keys: Sequence[str] = ("id", "time"), time: str = "time"
) -> None:
    """Insert rows, skipping keys already present, so a replayed batch changes nothing.

    Only the days that ``new`` touches are read back.
    """
    fresh = new.withColumn("day", F.to_date(time))
    try:
        stored = new.sparkSession.read.parquet(path)
    except AnalysisException:
        stored = None
    if stored is not None:
        days = fresh.select("day").distinct()
        seen = stored.join(days, on="day", how="left_semi")
        fresh = new_rows(fresh, seen, keys)
    else:
        fresh = fresh.dropDuplicates(list(keys))
    fresh.repartition("day").write.mode("append").partitionBy("day").parquet(path)


def write_once(new: DataFrame, path: str, run: str, batch: int, time: str = "time") -> None:
    """The rows of one micro-batch in folders of their own: by day, run and batch number.

    Writing the same batch of the same run again replaces what is there, so a batch repeated
    after a failure leaves the table as one pass would; nothing is read back. ``run`` names
    the stream: one that starts anew from another checkpoint counts its batches from zero
    again and is another run, whose rows stand beside the first's.
    """
    (
        new.withColumn("day", F.to_date(time)).withColumn("run", F.lit(run)).withColumn("batch", F.lit(int(batch)))
        .repartition("day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "run", "batch").parquet(path)
    )


def written_before(spark: SparkSession, path: str, run: str, batch: int) -> DataFrame | None:
    """What a table written by ``write_once`` held before this batch, whether or not the
    batch has been written already; nothing where there is no table yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        return None
    return stored.where((F.col("run").cast("string") != run) | (F.col("batch") < batch))


# -- retention -------------------------------------------------------------------


def drop_expired_days(spark: SparkSession, path: str, cfg: EngineConfig, as_of: date) -> list[str]:
    """Delete the day folders of a stored table that lie wholly before the retention time.

    The oldest kept day is ``retention_days`` before ``as_of``; ``retain`` cuts its rows exactly.
    Only names of folders are looked at, no data is read. A reader that has listed a day before
    it goes skips the files gone (``read_metrics``); kept days are never touched.
    """
    first = as_of - timedelta(days=cfg.retention_days)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        named = re.fullmatch(r"day=(\d{4}-\d\d-\d\d)", status.getPath().getName())
        if named and date.fromisoformat(named[1]) < first:
            fs.delete(status.getPath(), True)
            gone.append(named[1])
    return sorted(gone)


def latest(df: DataFrame, col: str) -> Column:
    """Largest value of a column as a scalar subquery (one row, computed on Spark)."""
    return df.agg(F.max(col).alias("latest")).scalar()


def retain(metrics: DataFrame, cfg: EngineConfig, as_of: Column | None = None) -> DataFrame:
    """Metrics of the last ``retention_days``; on a day-partitioned table whole days drop
    out by partition pruning."""
    since = (latest(metrics, "time") if as_of is None else as_of) - F.expr(f"INTERVAL {cfg.retention_days} DAYS")
    if "day" in metrics.columns:
        metrics = metrics.where(F.col("day") >= F.to_date(since))
    return metrics.where(F.col("time") >= since)


# -- recent rows -----------------------------------------------------------------


def clamp_seconds(seconds: int, cfg: EngineConfig) -> int:
    return max(1, min(int(seconds), cfg.history_max))


def recent_metrics(
    metrics: DataFrame, cfg: EngineConfig, seconds: int | None = None,
    as_of: float | None = None, t: str = "window_end",
) -> DataFrame:
    """Metric rows of the last ``seconds``, oldest first.

    With a clock (``as_of``) rows strictly newer than it minus ``seconds``; without one,
    rows at or after the newest row minus ``seconds``.
    """
    span = clamp_seconds(cfg.history_default if seconds is None else seconds, cfg)
    since = F.lit(float(as_of - span)) if as_of is not None else latest(metrics, t) - F.lit(float(span))
    kept = metrics.where(F.col(t) > since if as_of is not None else F.col(t) >= since)
    if "day" in metrics.columns:
        kept = kept.where(F.col("day") >= F.to_date(from_epoch(since)))
    return kept.orderBy(t, "series")


def recent_anomalies(anomalies: DataFrame, limit: int = 100) -> DataFrame:
    """Newest first. ``limit`` after ``orderBy`` plans as a per-task top-N."""
    return anomalies.orderBy(F.col("ts").desc(), "id").limit(limit)


def list_anomalies(anomalies: DataFrame, cfg: EngineConfig, limit: int = 50) -> DataFrame:
    return recent_anomalies(anomalies, max(0, min(limit, cfg.anomaly_buffer)))


def last_n(df: DataFrame, n: int, order: str = "window_id", per_series: bool = True) -> DataFrame:
    """The newest ``n`` rows, of each series or overall (of one time, the first series first)."""
    if not per_series:
        return df.orderBy(F.col(order).desc(), *(["series"] if "series" in df.columns else [])).limit(n)
    newest = Window.partitionBy("series").orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def newest_days(stored: DataFrame, n: int) -> DataFrame:
    """The last days of a table stored by day that hold its newest ``n`` rows.

    Days are known from the names of the table's folders. They are walked backwards, twice as
    many at each step, and only the rows of these days are counted, until there are enough.
    """
    named = {m[1] for f in stored.inputFiles() if (m := re.search(r"/day=(\d{4}-\d\d-\d\d)/", f))}
    if "day" not in stored.columns or not named:
        return stored
    days, step = sorted(named, reverse=True), 1
    while step < len(days):
        recent = stored.where(F.col("day") >= F.lit(days[step - 1]).cast("date"))
        if recent.limit(n).count() >= n:
            return recent
        step *= 2
    return stored


def _in_order(rows: Column, keys: Sequence[tuple[str, int]]) -> Column:
    """An array of structs ordered by some of their fields, 1 for rising and -1 for falling; the
    others need no order of their own."""
    def compare(x: Column, y: Column) -> Column:
        out = F.lit(0)
        for name, sign in reversed(keys):
            out = F.when(x[name] < y[name], F.lit(-sign)).when(x[name] > y[name], F.lit(sign)).otherwise(out)
        return out
    return F.array_sort(rows, compare)


def snapshot(metrics: DataFrame, anomalies: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row for a newly connected client: the buffered metrics (oldest first) and
    anomalies (newest first). Both lists are bounded by the buffer sizes; of stored tables
    only the days that hold them are read."""
    metrics, anomalies = newest_days(metrics, cfg.metric_buffer), newest_days(anomalies, cfg.anomaly_buffer)
    m = last_n(metrics, cfg.metric_buffer, "window_end", per_series=False)
    a = recent_anomalies(anomalies, cfg.anomaly_buffer)
    packed_m = m.agg(_in_order(F.collect_list(
        F.struct("window_end", *[c for c in m.columns if c != "window_end"])), [
            ("window_end", 1), *([("series", 1)] if "series" in m.columns else [])]).alias("metrics"))
    packed_a = a.agg(_in_order(F.collect_list(
        F.struct("ts", *[c for c in a.columns if c not in ("ts", "available")])), [("ts", -1), ("id", 1)]).alias("anomalies"))
    return packed_m.withColumn("anomalies", packed_a.scalar()).withColumn(
        "tick_seconds", F.lit(float(cfg.tick_seconds))).withColumn("source", F.lit(cfg.source))


# -- incidents -------------------------------------------------------------------


def incidents(
    anomalies: DataFrame, metrics: DataFrame, cfg: EngineConfig,
    t: str = "window_end", on_series: bool = True, record: Sequence[str] = (),
) -> DataFrame:
    """Every anomaly with the metric rows within +-pad seconds of it.

    An anomaly whose metrics have expired keeps one row, with null metrics. ``record`` names
    further columns of the anomaly to carry, under an ``anomaly_`` prefix.

    An interval join as an equi-join: both sides fall into buckets of one pad, an anomaly
    reaches the three around it, the exact test follows on the bucket matches. Metrics stored
    by day are joined on the day as well, so days without an anomaly are not read.
    """
    pad = float(cfg.incident_pad)
    bucket = lambda c: F.floor(c / F.lit(pad)).cast("long")
    whose = anomalies.select(
        F.col("id").alias("anomaly_id"), F.col("ts").alias("anomaly_ts"),
        *[F.col(c).alias(f"anomaly_{c}") for c in record], *(["series"] if on_series else []))
    ends = (bucket(F.col("anomaly_ts") - pad), bucket(F.col("anomaly_ts") + pad))
    a = whose.withColumn("_b", F.explode(F.sequence(*ends)))
    m = metrics.withColumn("_b", bucket(F.col(t)))
    keys = ["series", "_b"] if on_series else ["_b"]
    if "day" in metrics.columns:
        edge = lambda b: F.to_date(from_epoch(b * F.lit(pad)))
        a = a.withColumn("day", F.explode(F.sequence(edge(F.col("_b")), edge(F.col("_b") + 1))))
        keys = [*keys, "day"]
    near = F.col(t).between(F.col("anomaly_ts") - pad, F.col("anomaly_ts") + pad)
    found = m.join(a, on=keys, how="inner").where(near).drop("_b")
    bare = whose.join(found.select("anomaly_id", "anomaly_ts"), ["anomaly_id", "anomaly_ts"], "left_anti")
    return found.unionByName(bare, allowMissingColumns=True)


def incident(
    anomaly_id: str, anomalies: DataFrame, metrics: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """One anomaly's record and the series around it, oldest first; no rows for an unknown id."""
    one = anomalies.where(F.col("id") == anomaly_id)
    record = [c for c in one.columns if c not in ("id", "ts", "series", "day", "time")]
    return incidents(one, metrics, cfg, record=record).orderBy("window_end")


# -- pipeline counters -------------------------------------------------------------


def pipeline_stats(
    events: DataFrame, scored: DataFrame, anomalies: DataFrame, cfg: EngineConfig
) -> DataFrame:
    seen = events.agg(F.count(F.lit(1)).alias("n")).scalar()
    raised = anomalies.agg(F.count(F.lit(1)).alias("n")).scalar()
    names = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(n not in cfg.unavailable).alias("available"))
        for n in cfg.detectors
    ])
    return scored.agg(
        F.count(F.lit(1)).alias("snapshots"),
        half_up(F.max_by("rate", F.struct("window_id", "series")), 3).alias("last_rate"),
    ).select(
        seen.alias("events_seen"), "snapshots", raised.alias("anomalies"), "last_rate",
        names.alias("detectors"),
    )
