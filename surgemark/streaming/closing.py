"""Streaming stage 1: events to closed windows.

Two policies. ``event_time`` waits for a watermark and drops what comes later; it is one
append-mode aggregation keyed by (series, window, dim, value), whose closed groups are cut to
the K leading values of each dimension, many windows at a time, in salted parts first where
asked for. So the events of a hot window or a single series meet no single task, and no task
holds a window's values: it holds K of each dimension while they pass. ``fold`` never drops:
late events count in the window that is open when they arrive, worked out batch by batch with
the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from surgemark.config import EngineConfig
from surgemark.functions.scalar import with_series
from surgemark.operators.windows import (
    COUNTS, count_windows, dim_counts, dim_topk, fold_late, window_id,
)

SUBJECT, ACTOR, TOTAL = "@subject", "@actor", "@all"
COUNTED = [SUBJECT, ACTOR, TOTAL]
WINDOW = ["series", "window_id"]
SUMMED = {"closed_at": "first", "n": "sum", SUBJECT: "sum", ACTOR: "sum", "bots": "sum", "news": "sum", "bytes": "sum"}
PARTS = 128                   # groups that closed windows are dealt into
HELD = 50_000                 # rows of a group that are merged at a time
LAST_SEQ = 2 ** 63 - 1        # stands for a missing sequence number
CLOSED_SCHEMA = (
    "series string, window_id long, count long, distinct_subjects long, distinct_actors long, "
    "bot_count long, new_count long, bytes_changed long, "
    "dims array<struct<dim:string,rk:int,value:string,cnt:long>>"
)

CLOSED_AT = CLOSED_SCHEMA + ", closed_at timestamp"
PARTIAL = (
    "series string, window_id long, dim string, value string, cnt long, first_seq long, "
    "bots long, news long, bytes long, closed_at timestamp"
)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> None:
    """Operators with state of their own need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def dedupe_stream(events: DataFrame, delay: str) -> DataFrame:
    """Optional: drop repeats of (source, id) within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["source", "id"])


def closed_windows(
    events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = (),
    delay: str = "0 seconds", watermarked: bool = False, salts: int = 1,
) -> DataFrame:
    """Windows complete under the watermark, with counters and ranked dimension values.

    The counted values of a window pass one task; with ``salts`` they are cut in as many parts
    first, for windows with millions of different values.

    Every event contributes a row for itself, its subject, its actor and each tracked
    dimension value. Distinct counts are then plain counts of (window, value) groups,
    exact and incremental, where streams allow no distinct aggregate.
    """
    tick = f"{cfg.tick_us} microseconds"
    pair = lambda dim, value: F.struct(F.lit(dim).alias("dim"), value.alias("value"))
    tracked = F.transform(
        F.array(*[F.lit(d) for d in cfg.track_dims]),
        lambda d: F.struct(d.alias("dim"), F.element_at("dims", d).alias("value")),
    )
    facts = F.concat(
        F.array(pair(TOTAL, F.lit("all")), pair(SUBJECT, F.col("subject")), pair(ACTOR, F.col("actor"))),
        tracked,
    )
    placed = with_series(events, series_cols)
    if not watermarked:
        placed = placed.withWatermark("ts", delay)
    values = (
        placed.select(
            "series", "ts", "seq", "bot", "kind", "bytes_delta",
            F.explode(F.filter(facts, lambda f: f["value"].isNotNull() & (f["value"] != ""))).alias("f"),
        )
        .groupBy("series", F.window("ts", tick).alias("w"), F.col("f.dim").alias("dim"),
                 F.col("f.value").alias("value"))
        .agg(
            F.count(F.lit(1)).alias("cnt"), F.min("seq").alias("first_seq"),
            F.count_if("bot").alias("bots"), F.count_if(F.col("kind") == "new").alias("news"),
            F.sum(F.abs("bytes_delta")).alias("bytes"),
        )
    )
    configure(events.sparkSession)
    closed = values.select(
        "series", window_id(F.col("w.start"), cfg).alias("window_id"), "dim", "value", "cnt",
        F.coalesce("first_seq", F.lit(LAST_SEQ)).alias("first_seq"), "bots", "news",
        F.coalesce("bytes", F.lit(0)).alias("bytes"), F.window_time("w").alias("closed_at"))
    whole = ["series", "window_id"]
    if salts > 1:
        parted = closed.withColumn("salt", F.pmod(F.xxhash64("dim", "value"), F.lit(salts)))
        closed = _leading(parted, [*whole, "salt"], LeadingValues(cfg, False), PARTIAL)
    # What salted parts pass on is counted already.
    return _leading(closed, whole, LeadingValues(cfg, True, salts > 1), CLOSED_AT)


def _leading(values: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    """Windows (or salted parts) pass the processor in ``PARTS`` groups of whole ones."""
    groups = values.withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(PARTS))).groupBy("part")
    return groups.transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="closed_at")


class LeadingValues(StatefulProcessor):
    """Counters and the leading dimension values of closed windows, or of salted parts of them.

    The aggregation before it emits all values of a window in the batch that closes the window,
    so a group is complete when it arrives and nothing has to outlast the batch. Rows pass in
    frames of bounded size; of each window and dimension the ``dim_topk`` greatest counts are
    held, earlier seen ones first.
    """

    def __init__(self, cfg: EngineConfig, final: bool, counted: bool = False) -> None:
        self.dims, self.k, self.final, self.counted = list(cfg.track_dims), cfg.dim_topk, final, counted

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def _merge(self, frames: list[pd.DataFrame]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Sums of the counters, and the leading values, of rows and of earlier results."""
        sums = pd.concat([f for f in frames if "n" in f]).groupby(WINDOW, as_index=False, dropna=False).agg(SUMMED)
        best = pd.concat([f for f in frames if "n" not in f])
        best = best.sort_values([*WINDOW, "dim", "cnt", "first_seq", "value"], ascending=[True] * 3 + [False, True, True])
        return sums, best.groupby([*WINDOW, "dim"], sort=False, dropna=False).head(self.k)

    def _split(self, rows: pd.DataFrame) -> list[pd.DataFrame]:
        """Rows that count, one column for each counter, and values that may lead."""
        total = rows["dim"] == TOTAL
        own = rows["dim"].isin(COUNTED)
        some, total = rows[own], total[own]
        n = some["cnt"].where(total | self.counted, 1)
        counts = some[[*WINDOW, "closed_at"]].assign(
            n=n.where(total, 0), **{c: n.where(some["dim"] == c, 0) for c in (SUBJECT, ACTOR)},
            **{c: some[c].where(total, 0) for c in ("bots", "news", "bytes")})
        return [counts, rows.loc[~own, [*WINDOW, "dim", "value", "cnt", "first_seq", "closed_at"]]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames, size, held = [], 0, 0
        for chunk in rows:
            frames += self._split(chunk)
            size += len(chunk)
            if size > max(held, HELD):
                frames = list(self._merge(frames))
                held, size = len(frames[1]), 0
        sums, best = self._merge(frames)
        yield from self._closed(sums, best) if self.final else self._partial(sums, best)

    def _closed(self, sums: pd.DataFrame, best: pd.DataFrame) -> Iterator[pd.DataFrame]:
        place = {dim: i for i, dim in enumerate(self.dims)}
        dims: dict[tuple, list[list]] = {}
        for series, window, dim, value, cnt in zip(*(best[c].tolist() for c in (*WINDOW, "dim", "value", "cnt"))):
            if dim in place:
                held = dims.setdefault((series, window), [[] for _ in place])[place[dim]]
                held.append({"dim": dim, "rk": len(held) + 1, "value": value, "cnt": cnt})
        nested = [[d for held in dims.get(w, ()) for d in held] for w in zip(sums["series"].tolist(), sums["window_id"].tolist())]
        yield pd.DataFrame({
            "series": sums["series"], "window_id": sums["window_id"], "count": sums["n"],
            "distinct_subjects": sums[SUBJECT], "distinct_actors": sums[ACTOR], "bot_count": sums["bots"],
            "new_count": sums["news"], "bytes_changed": sums["bytes"], "dims": nested, "closed_at": sums["closed_at"]})

    def _partial(self, sums: pd.DataFrame, best: pd.DataFrame) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in PARTIAL.split(", ")]
        none = {"value": None, "first_seq": LAST_SEQ, "bots": 0, "news": 0, "bytes": 0}
        for dim, column in ((SUBJECT, SUBJECT), (ACTOR, ACTOR), (TOTAL, "n")):
            some = sums[sums[column] > 0]
            own = {c: some[c] for c in ("bots", "news", "bytes")} if dim == TOTAL else {}
            yield some[[*WINDOW, "closed_at"]].assign(**{**none, **own, "dim": dim, "cnt": some[column]})[names]
        yield best.assign(bots=0, news=0, bytes=0)[names]

    def close(self) -> None:
        pass


def _table(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def fold_batch(
    batch: DataFrame, batch_id: int, path: str, cfg: EngineConfig, series_cols: Sequence[str] = ()
) -> None:
    """One micro-batch of the ``fold`` policy, for ``foreachBatch``.

    Events of the still open windows wait in ``<path>/open/<batch>``; together with the
    new events they are folded by the batch operator and whatever lies before the open
    window of its series goes to ``<path>/closed/batch=<batch>``. Both are overwritten by
    batch number, so a retried batch ends in the same state; what older batches left
    waiting is deleted.
    """
    spark = batch.sparkSession
    fresh = (
        with_series(batch, series_cols).where(F.col("ts").isNotNull())
        .withColumn("window_id", window_id(F.col("ts"), cfg))
    )
    waiting = _table(spark, f"{path}/open/{batch_id - 1}") if batch_id > 0 else None
    # Read once, folded once: everything below asks for these rows several times.
    arrived = (fresh if waiting is None else fresh.unionByName(waiting)).persist()
    placed = fold_late(arrived).persist()
    try:
        current = placed.groupBy("series").agg(F.max("window_id").alias("_open"))
        split = placed.join(current, "series")
        split.where("window_id = _open").drop("_open").write.mode("overwrite").parquet(
            f"{path}/open/{batch_id}")
        _write_closed(split.where("window_id < _open").drop("_open"), f"{path}/closed/batch={batch_id}", cfg)
    finally:
        placed.unpersist()
        arrived.unpersist()
    if batch_id > 1:                  # the batch before this one is committed, so nothing reads it again
        _forget(spark, f"{path}/open/{batch_id - 2}")


def _forget(spark, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _write_closed(done: DataFrame, path: str, cfg: EngineConfig) -> None:
    topk = dim_topk(dim_counts(done, cfg, placed=done), cfg)
    nested = topk.groupBy("series", "window_id").agg(
        F.array_sort(F.collect_list(F.struct("dim", "rk", "value", "cnt"))).alias("dims"))
    empty = F.array().cast("array<struct<dim:string,rk:int,value:string,cnt:long>>")
    (
        count_windows(done).join(nested, ["series", "window_id"], "left")
        .withColumn("dims", F.coalesce("dims", empty))
        .write.mode("overwrite").parquet(path)
    )


def flush_open(spark, path: str, batch_id: int, cfg: EngineConfig) -> None:
    """Close the windows still open after batch ``batch_id``, once no event will follow."""
    waiting = _table(spark, f"{path}/open/{batch_id}")
    if waiting is not None:
        _write_closed(waiting, f"{path}/closed/batch={batch_id + 1}", cfg)


def fold_stream(
    events: DataFrame, path: str, checkpoint: str, cfg: EngineConfig,
    series_cols: Sequence[str] = (), **trigger,
):
    """Start the ``fold`` policy; closed windows appear under ``<path>/closed``.

    ``seq`` must follow arrival across batches.
    """
    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda df, n: fold_batch(df, n, path, cfg, series_cols))
        .start()
    )


def read_closed(spark, path: str) -> DataFrame:
    """Closed windows of ``fold_stream`` as a stream for the scorer."""
    return (
        spark.readStream.schema(CLOSED_SCHEMA).option("recursiveFileLookup", "true")
        .parquet(f"{path}/closed")
    )
