"""Best-fit packing of documents into sequences of several permitted lengths.

A document takes as many places as it has words, and one for its end. Documents longer than
the largest length are cut, and the rest is packed like any other.

Pieces are dealt out by hash of id, text and piece into shards of about ``SHARD`` pieces, whatever the number of
documents, and each shard is packed by itself, longest piece first:

* a piece goes where it leaves the least room;
* if it fits nowhere, the permitted lengths are weighed against each other: each is filled
  on trial with the shard's remaining pieces, and the one with the least cost for what it
  would hold is opened;
* at the end each sequence shrinks to the smallest permitted length that holds it.

The cost of a sequence is its length and ``OVERHEAD`` places.

Odd input: null and empty texts take one place; rows repeated with one doc_id are packed
each; a null doc_id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import shuffle_partitions, text_or_empty
from surgemark.plans.staging import stage

LENGTHS = (256, 512, 1024, 2048, 4096)
SHARD = 8192
OVERHEAD = 16
PLACED = "doc_id long, piece long, start long, n_tokens long, bin_id string, capacity long, offset long"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


class Remaining:
    """Lengths still to be packed: how many of each, and which come next below a length."""

    def __init__(self, lengths: list[int]):
        self.count = Counter(lengths)
        self.sorted = sorted(self.count)

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.sorted.pop(bisect_left(self.sorted, length))

    def fill(self, room: int, steps: int = 12) -> int:
        """How much of ``room`` the largest pieces that fit would take, a few steps ahead."""
        used, taken = 0, Counter()
        i = bisect_right(self.sorted, room) - 1
        while i >= 0 and steps:
            length = self.sorted[i]
            if length <= room - used and self.count[length] > taken[length]:
                taken[length] += 1
                used += length
                steps -= 1
            else:
                i = min(i, bisect_right(self.sorted, room - used)) - 1
        return used


def best_fit(lengths: list[int], permitted: tuple[int, ...], overhead: int = OVERHEAD) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; ``lengths`` must not increase, nor exceed the largest."""
    permitted = tuple(sorted(permitted))
    left = Remaining(lengths)
    rooms: list[tuple[int, int]] = []        # (room, sequence), sorted
    used: list[int] = []
    out = []
    for length in lengths:
        left.take(length)
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
        else:
            room = min((c for c in permitted if c >= length),
                       key=lambda c: ((c + overhead) / (length + left.fill(c - length)), c))
            k = len(used)
            used.append(0)
        out.append((k, used[k]))
        used[k] += length
        if room > length:
            insort(rooms, (room - length, k))
    return out


def pack(docs: DataFrame, *, permitted: tuple[int, ...] = LENGTHS, shard: int = SHARD, size=None) -> DataFrame:
    """One row for each piece: where it comes from, its sequence, and its place there.

    ``size`` maps the text column to the number of places (words and one more by default).
    """
    permitted = tuple(sorted(permitted))
    top = permitted[-1]
    size = size or (lambda text: n_words(text) + 1)
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size(text_or_empty()).cast("long").alias("n"),
                        F.xxhash64("doc_id", text_or_empty()).alias("digest"))
    pieces = stage(
        items.select("doc_id", "n", "digest", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {top}"))).alias("piece"))
        .select("doc_id", "digest", "piece", (F.col("piece") * top).alias("start"),
                F.least(F.lit(top), F.col("n") - F.col("piece") * top).alias("n_tokens")), "pack-pieces")
    shards = max(1, -(-pieces.count() // shard))

    def packed(group: list[tuple]) -> Iterator[pa.RecordBatch]:
        shard_no = group[0][0]
        places = best_fit([g[4] for g in group], permitted)
        used: Counter = Counter()
        for (k, _), g in zip(places, group):
            used[k] += g[4]
        capacity = {k: next(c for c in permitted if c >= n) for k, n in used.items()}
        rows = [(*g[1:], f"{shard_no}-{k}", capacity[k], offset) for g, (k, offset) in zip(group, places)]
        names = [f.split()[0] for f in PLACED.split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in PLACED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != row[0]:
                    yield from packed(group)
                    group = []
                group.append(row)
        if group:
            yield from packed(group)

    dealt = pieces.select(F.pmod(F.xxhash64("digest", "piece"), F.lit(shards)).alias("shard"), "doc_id", "piece", "start", "n_tokens")
    # A number of partitions, so that small rows with much work are not merged into few tasks.
    tasks = min(shards, 4 * shuffle_partitions(docs.sparkSession))
    ordered = dealt.repartition(tasks, "shard").sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece")
    return ordered.mapInArrow(run, PLACED)
