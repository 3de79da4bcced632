"""Tumbling-window metrics, late folding, per-dimension counts and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.config import FEATURES, EngineConfig
from surgemark.functions.scalar import blank_to_null, with_series
from surgemark.operators.prefix import running_extremes

COUNTS = ("count", "distinct_subjects", "distinct_actors", "bot_count", "new_count", "bytes_changed")
RATIOS = ("rate", "bot_ratio", "bytes_per_sec", "new_rate")
WINDOW_COLUMNS = (
    "series", "window_id", "window_start", "window_end", "tick_seconds",
    *COUNTS, *RATIOS,
)
SEQ_CHUNK = 1_000_000


# -- placing events in windows -------------------------------------------------


def window_id(ts: Column, cfg: EngineConfig) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(cfg.tick_us)).cast("long")


def place_events(events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``series`` and ``window_id``; rows without a time cannot be placed."""
    placed = (
        with_series(events, series_cols)
        .where(F.col("ts").isNotNull())
        .withColumn("window_id", window_id(F.col("ts"), cfg))
    )
    return fold_late(placed) if cfg.late == "fold" else placed


def fold_late(placed: DataFrame, chunk_rows: int = SEQ_CHUNK) -> DataFrame:
    """Count an event that is behind the clock in the window that was open on arrival.

    The open window is the running maximum of window ids in arrival order (``seq``). An
    equal ``seq`` is broken by time, so the result does not depend on task order.
    """
    chunked = placed.withColumn("_chunk", F.floor(F.col("seq") / F.lit(chunk_rows)))
    rolled = running_extremes(
        chunked, ["series"], "_chunk", ["seq", "ts"],
        {"_open": ("max", F.col("window_id"))},
    )
    return rolled.withColumn("window_id", F.col("_open")).drop("_open", "_chunk")


# -- metrics -------------------------------------------------------------------


def derived_columns(cfg: EngineConfig) -> list[Column]:
    tick = F.lit(float(cfg.tick_seconds))
    n = F.col("count")
    start = F.col("window_id") * tick
    return [
        start.alias("window_start"), (start + tick).alias("window_end"),
        tick.alias("tick_seconds"),
        (n / tick).alias("rate"),
        F.when(n > 0, F.col("bot_count") / n).otherwise(F.lit(0.0)).alias("bot_ratio"),
        (F.col("bytes_changed") / tick).alias("bytes_per_sec"),
        (F.col("new_count") / tick).alias("new_rate"),
    ]


def with_ratios(counts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Derive rates, ratios and window bounds from the integer counters."""
    return counts.select("*", *derived_columns(cfg)).select(*WINDOW_COLUMNS)


def count_windows(placed: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Counters per non-empty window. Counts, sums and both exact distincts combine
    map-side; the distinct values of one hot window spread over tasks by value."""
    subject, actor = (blank_to_null(F.col(c)) for c in ("subject", "actor"))
    distinct = F.approx_count_distinct if approx_distinct else F.count_distinct
    return placed.groupBy("series", "window_id").agg(
        F.count(F.lit(1)).alias("count"),
        distinct(subject).alias("distinct_subjects"),
        distinct(actor).alias("distinct_actors"),
        F.count_if("bot").alias("bot_count"),
        F.count_if(F.col("kind") == "new").alias("new_count"),
        F.coalesce(F.sum(F.abs("bytes_delta")), F.lit(0)).cast("long").alias("bytes_changed"),
    )


def window_metrics(
    events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = (),
    approx_distinct: bool = False,
) -> DataFrame:
    """One row per non-empty window with counters and derived metrics."""
    placed = place_events(events, cfg, series_cols)
    return with_ratios(count_windows(placed, approx_distinct), cfg)


def features() -> Column:
    """The seven named doubles the multivariate detector reads, as one struct."""
    return F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURES])


def feature_map() -> Column:
    pairs = []
    for c in FEATURES:
        pairs += [F.lit(c), F.col(c).cast("double")]
    return F.create_map(*pairs)


# -- gap filling in time slices --------------------------------------------------


def series_bounds(
    windows: DataFrame, cfg: EngineConfig, flush_to: float | None = None
) -> DataFrame:
    """First and last emitted window of each series.

    ``flush_to`` advances the clock: windows before the one holding that moment are
    complete, the window the clock is in stays open.
    """
    last = F.max("window_id")
    if flush_to is not None:
        clock = int(flush_to * 1_000_000 // cfg.tick_us)
        last = F.greatest(last, F.lit(clock)) - 1
    elif not cfg.emit_open:
        last = last - 1
    return (
        windows.groupBy("series")
        .agg(F.min("window_id").alias("lo"), last.cast("long").alias("hi"))
        .where("hi >= lo")
    )


def dense_slices(
    windows: DataFrame, cfg: EngineConfig, flush_to: float | None = None,
    halo: int = 0, length: int | None = None,
) -> DataFrame:
    """Gap-filled windows cut into time slices that can be sequenced independently.

    A slice holds ``length`` consecutive windows and the ``halo`` windows before them
    (``in_slice`` is false there). Each slice gets one marker row at its start that knows
    the series bounds, so empty stretches need no per-series array, no join and no
    per-series task: inside a slice a row reaches to the next one, at most
    ``halo + length`` windows on. The result is partitioned by (series, slice).
    """
    length = length or cfg.slice_len
    size, back = F.lit(length), F.lit(halo)
    wid = F.col("window_id")

    marks = (
        series_bounds(windows, cfg, flush_to)
        .select(
            "series", "lo", "hi",
            F.explode(F.sequence(F.floor(F.col("lo") / size), F.floor(F.col("hi") / size)))
            .alias("slice"),
        )
        .select(
            "series", "slice",
            F.greatest("lo", F.col("slice") * size - back).alias("window_id"),
            *[F.lit(0).cast("long").alias(c) for c in COUNTS],
            F.col("lo"), F.col("hi"),
        )
    )
    first = F.floor(wid / size)
    copies = windows.select(
        "series",
        (F.explode(F.sequence(first, F.floor((wid + back) / size))) if halo else first)
        .alias("slice"),
        "window_id", *COUNTS,
        F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"),
    )
    group = Window.partitionBy("series", "slice")
    # Of a marker and a real row at the same window the marker sorts first and gets no span.
    line = group.orderBy("window_id", F.col("lo").isNull())
    spans = (
        marks.unionByName(copies)
        .withColumn("_next", F.lead("window_id").over(line))
        .withColumn("lo", F.first("lo", ignorenulls=True).over(line))
        .withColumn("hi", F.first("hi", ignorenulls=True).over(line))
        .where("lo IS NOT NULL AND window_id <= hi")
        .withColumn(
            "_end",
            F.least(
                F.coalesce(F.col("_next") - 1, F.col("hi")),
                F.col("hi"), (F.col("slice") + 1) * size - 1,
            ),
        )
        .where(F.col("_end") >= wid)
    )
    filled = spans.select(
        "series", "slice", "lo", "hi", *COUNTS, F.col("window_id").alias("_at"),
        F.explode(F.sequence(wid, F.col("_end"))).alias("window_id"),
    )
    real = F.col("_at") == wid
    counts = filled.select(
        "series", "slice", "lo", "hi", "window_id",
        *[F.when(real, F.col(c)).otherwise(F.lit(0).cast("long")).alias(c) for c in COUNTS],
    )
    return counts.select(
        "*", *derived_columns(cfg), (wid >= F.col("slice") * size).alias("in_slice")
    )




def fill_gaps(
    windows: DataFrame, cfg: EngineConfig, flush_to: float | None = None
) -> DataFrame:
    """Every window between first and last of each series, empty ones as zeros."""
    return dense_slices(windows, cfg, flush_to).select(*WINDOW_COLUMNS)


# -- dimensions ------------------------------------------------------------------


def dim_counts(
    events: DataFrame, cfg: EngineConfig, series_cols: Sequence[str] = (),
    placed: DataFrame | None = None,
) -> DataFrame:
    """Events per (series, window, dim, value) in one pass over all tracked dims."""
    placed = place_events(events, cfg, series_cols) if placed is None else placed
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dim"), F.col("dims")[d].alias("value")) for d in cfg.track_dims
    ])
    return (
        placed.select("series", "window_id", "seq", F.inline(pairs))
        .where("value <> ''")
        .groupBy("series", "window_id", "dim", "value")
        .agg(F.count(F.lit(1)).alias("cnt"), F.min("seq").alias("first_seq"))
    )


def dim_topk(counts: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Largest K values of each (window, dim); ties keep the first-seen value.

    ``row_number() <= K`` lets Spark cut each group to K rows before the shuffle, so a
    window with millions of values costs a task K rows per map output.
    """
    order = Window.partitionBy("series", "window_id", "dim").orderBy(
        F.col("cnt").desc(), F.col("first_seq"), F.col("value")
    )
    return (
        counts.withColumn("rk", F.row_number().over(order))
        .where(F.col("rk") <= cfg.dim_topk)
        .select("series", "window_id", "dim", "value", "cnt", "rk")
    )


def nest_dims(topk: DataFrame) -> DataFrame:
    """One row per window: ``dim -> [(value, cnt), ...]`` in rank order."""
    per_dim = topk.groupBy("series", "window_id", "dim").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rk", "value", "cnt"))),
            lambda r: F.struct(r["value"].alias("value"), r["cnt"].alias("cnt")),
        ).alias("vals")
    )
    return per_dim.groupBy("series", "window_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("dim", "vals")))).alias("dim_counts")
    )
