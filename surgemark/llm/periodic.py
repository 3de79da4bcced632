r"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words (``[^\x20\x09-\x0D]+``) with smallest period q and at
least ``max(SHORTEST, 2 * q)`` words, that no neighbouring word extends keeping the period.

1. Splitting. Every word of a run occurs in it at least twice. So a word that occurs once in
   its segment (at first, the text) is in no run, and splits the segment; stretches under
   ``SHORTEST`` words are let go. Segments that were split are counted again, until none is.
   The first ``ROUNDS`` rounds count all open segments of a batch together. What is open
   after that is split by looking from both ends for a word whose neighbours of its kind lie
   outside, so the cost is at most n log n, however the words are arranged.
2. Lag scan. A stretch of words equal to those q further on is, for a run, at least
   ``step = max(q, SHORTEST - q)`` long. So at lag q every ``step``-th word is compared,
   which is m log m comparisons for all lags of a segment of m words. Where one agrees, the
   stretch is extended both ways by ranks of word strings of 1, 2, 4, ... words (equal ranks
   are equal strings, so this is exact). Of stretches with the same ends the least lag stays.

All work on a text is done in the task that reads it; nothing is shuffled.

Odd input: a null, empty or blank text has no words and no runs, and collapses to an empty
text; any length works, one text at a time being held with a few numbers for each word; rows
repeated with one doc_id give one row each, a null doc_id too; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import text_or_empty

SHORTEST = 12                 # words of a run, at least
ROUNDS = 4                    # rounds in which all segments of a batch are counted together
TOGETHER = 200_000            # words of texts that are worked on together
PAIRS = 1_000_000             # comparisons at different lags that are made at a time

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)),
                    ("collapsed", pa.binary())])
_SQL = "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"


# --- splitting -------------------------------------------------------------------------

def stretches(keep: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of kept places; none reaches over an edge (a first place)."""
    n = len(keep)
    fresh = keep.copy()
    fresh[1:] &= ~keep[:-1] | edge[1:]
    last = keep.copy()
    last[:-1] &= ~keep[1:] | edge[1:]
    return np.flatnonzero(fresh), np.flatnonzero(last) + 1 if n else np.zeros(0, np.int64)


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each stretch, one stretch after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def split(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Segments start..end of word numbers, cut until every word of each occurs twice in it."""
    settled: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        size = end - start
        start, size = start[size >= SHORTEST], size[size >= SHORTEST]
        if not len(start):
            return settled
        at = _places(start, size)
        owner = np.repeat(np.arange(len(start)), size)
        code = owner * (int(words[at].max()) + 1) + words[at]
        _, kind, times = np.unique(code, return_inverse=True, return_counts=True)
        twice = times[kind] > 1
        whole = np.bincount(owner, weights=~twice, minlength=len(start)) == 0
        settled += zip(start[whole].tolist(), (start + size)[whole].tolist())
        edge = np.concatenate([[True], owner[1:] != owner[:-1]])
        first, last = stretches(twice & ~whole[owner], edge)
        start, end = at[first], at[last - 1] + 1
    for lo, hi in zip(start.tolist(), end.tolist()):
        settled += split_from_ends(words, lo, hi)
    return settled


def split_from_ends(words: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
    """The same for one segment. A cut costs as much as its smaller side is long."""
    part = words[lo:hi]
    order = np.argsort(part, kind="stable")
    same = np.flatnonzero(part[order[1:]] == part[order[:-1]])
    before, after = np.full(hi - lo, -1), np.full(hi - lo, hi - lo)
    before[order[same + 1]], after[order[same]] = order[same], order[same + 1]
    before, after = before.tolist(), after.tolist()
    settled, todo = [], [(0, hi - lo)]
    while todo:
        a, b = todo.pop()
        if b - a < SHORTEST:
            continue
        i, j = a, b - 1
        while i <= j:
            if before[i] < a and after[i] >= b:
                todo += (a, i), (i + 1, b)
                break
            if before[j] < a and after[j] >= b:
                todo += (a, j), (j + 1, b)
                break
            i, j = i + 1, j - 1
        else:
            settled.append((lo + a, lo + b))
    return settled


# --- lag scan ----------------------------------------------------------------------------

def ranks(part: np.ndarray, longest: int) -> list[np.ndarray]:
    """ranks[k][i] numbers the string of 2 ** k words from i on."""
    _, first = np.unique(part, return_inverse=True)
    out = [first.astype(np.int64)]
    while 2 << len(out) - 1 <= longest and len(out[-1]) > 1 << len(out) - 1:
        r, half = out[-1], 1 << len(out) - 1
        pair = r[:-half] * (int(r.max()) + 1) + r[half:]
        out.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
    return out


def _reach(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """How many words from i on (or, with ``back``, up to before i) equal those at j > i."""
    done = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        # Strings at most double as long as all before can follow, so two tries are enough.
        for _ in range(2):
            a, b = (i - done - size, j - done - size) if back else (i + done, j + done)
            fits = np.flatnonzero((a >= 0) & (b < len(level)))
            same = fits[level[a[fits]] == level[b[fits]]]
            done[same] += size
    return done


def lag_scan(part: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment, by start and period."""
    m = len(part)
    levels = ranks(part, m)
    found: dict[tuple[int, int], int] = {}
    lags = np.arange(1, m // 2 + 1)
    steps = np.maximum(lags, SHORTEST - lags)
    tries = -(-(m - lags) // steps)
    cuts = np.searchsorted(np.cumsum(tries), np.arange(PAIRS, int(tries.sum()) + PAIRS, PAIRS))
    for lo, hi in zip([0, *(cuts + 1).tolist()], [*(cuts + 1).tolist(), len(lags)]):
        if lo >= min(hi, len(lags)):
            continue
        n = tries[lo:hi]
        q, step = np.repeat(lags[lo:hi], n), np.repeat(steps[lo:hi], n)
        i = _places(np.zeros(len(n), np.int64), n) * step
        hit = part[i] == part[i + q]
        i, q, step = i[hit], q[hit], step[hit]
        left = _reach(levels, i, i + q, True)
        equal = left + _reach(levels, i, i + q, False)
        long = equal >= step
        for key in set(zip((i - left)[long].tolist(), (equal + q)[long].tolist(), q[long].tolist())):
            found[key[:2]] = min(key[2], found.get(key[:2], m))
    return sorted((s, n, q) for (s, n), q in found.items())


def find_runs(words: np.ndarray, ends: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of each text; text k has the words up to ends[k], numbered from its first."""
    starts = np.concatenate([[0], ends[:-1]])
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for lo, hi in sorted(split(words, starts, ends)):
        text = int(np.searchsorted(ends, lo, side="right"))
        found[text] += [(lo + s - int(starts[text]), n, q) for s, n, q in lag_scan(words[lo:hi])]
    for text in range(len(ends)):
        yield found.get(text, [])


def dropped(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """True for the words that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


# --- operator ----------------------------------------------------------------------------

def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, n_words, runs (ordered by start and period) and collapsed (the words that stay,
    joined by one space, as bytes) of each row.

    ``rewrite`` may give, for a doc_id and its number of words, the places of the words that
    the text is to consist of instead.
    """

    def finish(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = defaultdict(count().__next__)
        words = np.array([number[w] for t in texts for w in t], np.int64)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        runs, kept = [], []
        for text, found in zip(texts, find_runs(words, ends)):
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            if found:
                gone = dropped(len(text), found).tolist()
                text = [w for w, g in zip(text, gone) if not g]
            kept.append(b" ".join(text))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(runs, pa.list_(RUN)), pa.array(kept, pa.binary())], schema=RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().split()
                places = rewrite(doc_id, len(words)) if rewrite else None
                if places is not None:
                    words = [words[p] for p in places.tolist()]
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
                if size >= TOGETHER or len(ids) >= 5_000:
                    yield finish(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield finish(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, _SQL)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """For about a tenth of the ids: the words from some place on repeat a short stretch."""
    import zlib

    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % period
    return places


def run_report(docs: DataFrame, rewrite=planted) -> DataFrame:
    """Per row: n_runs, the longest run, and digests of all runs and of the collapsed text."""
    best = F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    length: Column = -F.col("best.less")
    return (
        periodic_runs(docs, rewrite).withColumn("best", F.get(best, F.lit(0)))
        .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                length.alias("length"), F.col("best.period").alias("period"),
                F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
                F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    )
