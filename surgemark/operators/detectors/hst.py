"""Half-Space Trees over the seven window features (Tan, Ting & Liu, IJCAI 2011).

The trees are drawn before any data is seen, and a row of block k is scored only with the
node masses of block k-1. So nothing is sequential beyond one block: a slice whose halo
covers two blocks is scored on its own. Features are scaled by their running min/max;
the extremes before a slice come from per-slice extremes (see ``prefix``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from surgemark.config import FEATURES, EngineConfig
from surgemark.functions.scalar import half_up
from surgemark.operators.detectors.base import Detector, result_struct, row_number_in_series
from surgemark.operators.prefix import chunk_carries

# The multiplicative generator that draws the trees.
MODULUS = 2_147_483_647
MULTIPLIER = 48_271
SIZE_LIMIT = 0.1
RAW = "_hst_raw"


def split_table(trees: int, height: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, threshold) of every inner node, heap order, shape (trees, 2^height - 1).

    Draws 1..7 of a tree place its work range on each feature: ``s`` in [0,1) gives
    [s - r, s + r] with r = 2 max(s, 1-s). Draw 7+n picks the dimension of inner node n,
    which halves that dimension's current range.
    """
    n_dims, inner = len(FEATURES), 2 ** height - 1
    dims = np.zeros((trees, inner), dtype=np.int64)
    cuts = np.zeros((trees, inner))
    for tree in range(trees):
        x = 1 + (seed * 7_919 + tree * 104_729 + 12_345) % (MODULUS - 1)
        draws = []
        for _ in range(n_dims + inner):
            x = x * MULTIPLIER % MODULUS
            draws.append(x / MODULUS)
        s = np.array(draws[:n_dims])
        reach = 2 * np.maximum(s, 1 - s)
        lo, hi = {1: s - reach}, {1: s + reach}
        for node in range(1, inner + 1):
            q = int(draws[n_dims + node - 1] * n_dims)
            cut = (lo[node][q] + hi[node][q]) / 2
            dims[tree, node - 1], cuts[tree, node - 1] = q, cut
            if 2 * node <= inner:
                lo[2 * node], hi[2 * node] = lo[node], hi[node].copy()
                hi[2 * node][q] = cut
                lo[2 * node + 1], hi[2 * node + 1] = lo[node].copy(), hi[node]
                lo[2 * node + 1][q] = cut
    return dims, cuts


def node_paths(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray, height: int) -> np.ndarray:
    """Heap node ids (1-based) a row passes in each tree: shape (rows, trees, height+1)."""
    rows, trees = len(x), len(dims)
    path = np.ones((rows, trees, height + 1), dtype=np.int64)
    r, t = np.arange(rows)[:, None], np.arange(trees)[None, :]
    for d in range(height):
        at = path[:, :, d]
        right = x[r, dims[t, at - 1]] >= cuts[t, at - 1]
        path[:, :, d + 1] = 2 * at + right
    return path


def masses(path: np.ndarray, height: int) -> np.ndarray:
    """Rows that passed each node: shape (trees, 2^(height+1))."""
    trees, width = path.shape[1], 2 ** (height + 1)
    flat = path + (np.arange(trees) * width)[None, :, None]
    return np.bincount(flat.ravel(), minlength=trees * width).reshape(trees, width)


def score_rows(path: np.ndarray, mass: np.ndarray, window: int, height: int) -> np.ndarray:
    """1 - normalised mass along each path; a walk ends at its first light node."""
    trees = path.shape[1]
    m = mass[np.arange(trees)[None, :, None], path]
    heavy = m[:, :, :-1] >= SIZE_LIMIT * window
    reached = np.concatenate(
        [np.ones_like(heavy[:, :, :1]), np.logical_and.accumulate(heavy, axis=2)], axis=2
    )
    total = (m * reached * (2.0 ** np.arange(height + 1))).sum(axis=(1, 2))
    return 1.0 - total / (trees * window * (2 ** (height + 1) - 1))


def scale(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Running min/max scaling including the row itself; constant features map to 0."""
    lo = np.minimum(np.minimum.accumulate(x, axis=0), low)
    hi = np.maximum(np.maximum.accumulate(x, axis=0), high)
    span = hi - lo
    return np.where(span > 0, (x - lo) / np.where(span > 0, span, 1.0), 0.0)


class HalfSpaceTrees(Detector):
    name = "hst"

    def history(self, cfg: EngineConfig) -> int:
        return 2 * cfg.hst_window

    def prepare(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        # Extremes of everything before the first row (halo included) of each slice. The
        # halo length is read off the rows themselves: a slice starts at its smallest id.
        halo, length = cfg.halo, cfg.slice_len
        own = frame.where("in_slice").withColumn(
            "_part", F.floor((F.col("window_id") + F.lit(halo)) / F.lit(length))
        )
        specs = {}
        for c in FEATURES:
            specs[f"lo_{c}"] = ("min", F.col(c).cast("double"))
            specs[f"hi_{c}"] = ("max", F.col(c).cast("double"))
        carries = chunk_carries(own, ["series"], "_part", specs).withColumnRenamed("_part", "slice")

        schema = T.StructType(frame.schema.fields + [T.StructField(RAW, T.DoubleType())])
        height, window = cfg.hst_height, cfg.hst_window
        dims, cuts = split_table(cfg.hst_trees, height, cfg.hst_seed)
        names = list(FEATURES)

        def score(rows: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
            if rows.empty:
                return pd.DataFrame(columns=[f.name for f in schema.fields])
            rows = rows.sort_values("window_id", ignore_index=True)
            low = np.full(len(names), np.inf)
            high = np.full(len(names), -np.inf)
            if len(carry):
                first = carry.iloc[0]
                low = np.array([first[f"carry_lo_{c}"] for c in names], dtype=float)
                high = np.array([first[f"carry_hi_{c}"] for c in names], dtype=float)
                low, high = np.where(np.isnan(low), np.inf, low), np.where(np.isnan(high), -np.inf, high)
            x = scale(rows[names].to_numpy(dtype=float), low, high)
            block = ((rows["window_id"] - rows["lo"]) // window).to_numpy()
            out = np.zeros(len(rows))
            edges = np.flatnonzero(np.diff(block)) + 1
            previous = None
            for at, upto in zip([0, *edges], [*edges, len(rows)]):
                path = node_paths(x[at:upto], dims, cuts, height)
                if block[at] > 0 and previous is not None:
                    out[at:upto] = score_rows(path, previous, window, height)
                previous = masses(path, height)
            return rows.assign(**{RAW: out})[[f.name for f in schema.fields]]

        return (
            frame.groupBy("series", "slice")
            .cogroup(carries.groupBy("series", "slice"))
            .applyInPandas(score, schema)
        )

    def apply(self, frame: DataFrame, cfg: EngineConfig) -> DataFrame:
        x = F.col(cfg.value_metric).cast("double")
        raw = F.col(RAW)
        warming = row_number_in_series() + 1 <= cfg.hst_warmup
        result = result_struct(
            self.name,
            F.when(warming, F.lit(False)).otherwise(raw >= cfg.hst_threshold),
            F.when(warming, F.lit(0.0)).otherwise(raw), x, x,
            raw_score=half_up(raw, 4), warmup=F.when(warming, F.lit(True)),
        )
        return frame.withColumn(self.name, result).drop(RAW)
