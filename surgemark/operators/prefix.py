"""Running extremes over one long series without one long task.

``max``/``min`` compose, so a running extreme splits into: the extreme of each chunk
(partial aggregation, one small row per chunk), an exclusive running extreme over those
chunk rows, and a running extreme inside each chunk. Only chunk rows are ever sequenced
per series; the data itself is ordered inside ``(series, chunk)`` groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_AGG = {"max": F.max, "min": F.min}
_PICK = {"max": F.greatest, "min": F.least}


def chunk_carries(
    df: DataFrame, keys: Sequence[str], chunk: str, specs: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Per (keys, chunk): the extreme over all *earlier* chunks, as ``carry_<name>``."""
    heads = df.groupBy(*keys, chunk).agg(
        *[_AGG[kind](col).alias(f"head_{name}") for name, (kind, col) in specs.items()]
    )
    before = (
        Window.partitionBy(*keys).orderBy(chunk)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return heads.select(
        *keys, chunk,
        *[_AGG[kind](f"head_{name}").over(before).alias(f"carry_{name}")
          for name, (kind, _) in specs.items()],
    )


def running_extremes(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str],
    specs: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add ``<name>`` columns: running max/min in ``order``, current row included.

    The join and the in-chunk window share the partitioning on (keys, chunk), so the rows
    are shuffled once.
    """
    carries = chunk_carries(df, keys, chunk, specs)
    inside = (
        Window.partitionBy(*keys, chunk).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = df.join(carries, on=[*keys, chunk], how="left")
    out = joined
    for name, (kind, col) in specs.items():
        out = out.withColumn(
            name, _PICK[kind](F.col(f"carry_{name}"), _AGG[kind](col).over(inside))
        )
    return out.drop(*[f"carry_{name}" for name in specs])


def neighbour(
    df: DataFrame, keys: Sequence[str], chunk: str, order: str, value: Column, name: str,
    step: int = -1,
) -> DataFrame:
    """Add ``name``: ``value`` of the previous (-1) or next (+1) row of the series.

    Inside a chunk this is lag/lead; at a chunk edge it comes from the edge row of the
    nearest non-empty chunk. ``order`` should be unique within a series.
    """
    line = Window.partitionBy(*keys, chunk).orderBy(order)
    chunks = Window.partitionBy(*keys).orderBy(chunk)
    marked = df.withColumn("_v", value)
    edge = (F.max_by if step < 0 else F.min_by)("_v", order)
    shift = F.lag if step < 0 else F.lead
    edges = (
        marked.groupBy(*keys, chunk).agg(edge.alias("_edge"))
        .select(*keys, chunk, shift("_edge").over(chunks).alias("_beyond"))
    )
    return (
        marked.join(edges, on=[*keys, chunk], how="left")
        .withColumn(name, F.coalesce(shift("_v").over(line), "_beyond"))
        .drop("_v", "_beyond")
    )


def slice_rows(
    df: DataFrame, halo: int, length: int, key: str = "window_id"
) -> DataFrame:
    """Copy rows into slices of ``length`` keys plus the ``halo`` keys before them, so a
    bounded look-back can be evaluated inside ``(series, slice)`` groups."""
    k, size = F.col(key), F.lit(length)
    first = F.floor(k / size)
    return (
        df.withColumn("slice", F.explode(F.sequence(first, F.floor((k + F.lit(halo)) / size))))
        .withColumn("in_slice", k >= F.col("slice") * size)
    )
