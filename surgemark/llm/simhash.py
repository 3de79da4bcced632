"""Near-duplicates by SimHash and exact comparison in tiles.

A fingerprint has 64 bits: words are cut at ``[\x20\x09-\x0D]``, A-Z are lower-cased, and a
bit is set if it is set in over half of the XXH64 hashes (seed 42) of the text's three-word
shingles, repeats included. Texts link at ``RADIUS`` or fewer differing bits.

Distinct fingerprints are laid out in tiles by the number of set bits in each quarter of the
word. One differing bit changes one of these counts by one, so two tiles whose counts differ
by more than the radius in sum hold no link and are never paired (about one pair in sixty is).
A pair of tiles that remains is compared in full by numpy: exclusive-or, bit count. A tile
holds a bounded number of fingerprints; larger ones are split by hash, and the other side is
streamed past in batches. Of the links in a tile pair a star for each group that they
connect is kept, never all pairs. Groups are the connected components of these links.

Odd input: a null text is an empty text; texts without words have fingerprint 0 and link like
any other; with one or two words the whole sequence is the shingle; rows repeated with one
doc_id give one row each; a null doc_id never names a component unless it has no other;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import text_or_empty
from surgemark.llm.graph import components
from surgemark.plans.staging import stage

RADIUS = 2
SHINGLE = 3
QUARTERS = 4
TILE = 4096                   # fingerprints on the held side of a tile pair
SEED = 42


def fingerprint(text: bytes, block: int = 1 << 18) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split()       # of bytes: A-Z only, and exactly these six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return digest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:len(words) - SHINGLE + 1].tolist()
    end = end[SHINGLE - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(start), block):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(start[i:i + block], end[i:i + block])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > len(start)).tolist())


def row_key(doc_id: Column, text: Column) -> Column:
    """A digest that only rows with one doc_id and one text share."""
    part = F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("-")), F.lit(":"))
    return F.sha2(F.concat(part, F.coalesce(F.concat(F.lit("t"), text.cast("string")), F.lit(""))), 256)


def fingerprints(docs: DataFrame, **more: Column) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), and strings asked for, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), *batch.columns[2:]], names=["doc_id", "fp", *names])

    names = list(more)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"),
                       *(c.alias(n) for n, c in more.items()))
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{n} string" for n in names)]))


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Count differences that a tile's right-hand neighbours may have; one of each +- pair."""
    near = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= (0,) * QUARTERS]


def _tile(counts: list[Column]) -> Column:
    total = F.lit(0)
    for c in counts:
        total = total * 17 + c
    return total


def _stars(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between two sides: each linked fingerprint with one that its group shares."""
    apart = np.bitwise_count(left[:, None] ^ right[None, :])
    near = (apart <= radius) & (apart > 0)
    rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(rows):
        return []
    near = near[np.ix_(rows, cols)]
    label = np.arange(len(rows))
    while True:
        of_cols = np.where(near, label[:, None], len(rows)).min(0)
        new = np.minimum(label, np.where(near, of_cols[None, :], len(rows)).min(1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    left, right = left[rows], right[cols]
    return [(left, left[label]), (right, left[of_cols])]


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join what lies within the radius; ``nodes`` has distinct fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in (0, 1)])
            side, fp = batch.column(2).to_numpy(), batch.column(3).to_numpy().view(np.uint64)
            if not len(fp):
                continue
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            found = []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                now = (int(key[0, lo]), int(key[1, lo]))
                if now != held_key:
                    held_key, held = now, np.zeros(0, np.uint64)
                mid = lo + int(np.searchsorted(side[lo:hi], 1))
                held = np.concatenate([held, fp[lo:mid]])
                for i in range(mid, hi, 1024):
                    if len(held):
                        found += _stars(held, fp[i:min(i + 1024, hi)], radius)
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                real = a != b
                yield pa.RecordBatch.from_arrays([pa.array(a[real]), pa.array(b[real])], names=["a", "b"])

    quarter = 64 // QUARTERS
    counts = [F.bit_count(F.shiftrightunsigned("fp", i * quarter).bitwiseAND(F.lit((1 << quarter) - 1)))
              for i in range(QUARTERS)]
    placed = nodes.select("fp", F.array(*counts).alias("ones"))
    # At most 17^4 = 83,521 tiles, whatever the input: small enough to send everywhere.
    sizes = placed.groupBy(_tile([F.col("ones")[i] for i in range(QUARTERS)]).alias("tile")).agg(
        F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)
    own = placed.select("fp", _tile([F.col("ones")[i] for i in range(QUARTERS)]).alias("tile"))
    left = own.join(sizes, "tile").select(
        "tile", F.pmod(F.hash("fp"), F.col("blocks")).alias("block"), F.lit(0).alias("side"), "fp")
    shift = F.explode(F.array(*[F.array(*[F.lit(x) for x in d]) for d in _offsets(radius)])).alias("d")
    moved = [F.col("ones")[i] + F.col("d")[i] for i in range(QUARTERS)]
    inside = [(m >= 0) & (m <= quarter) for m in moved]
    valid = inside[0]
    for x in inside[1:]:
        valid = valid & x
    right = (
        placed.select("fp", "ones", shift).where(valid).select("fp", _tile(moved).alias("tile"))
        .join(sizes, "tile")
        .select("tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "fp")
    )
    pairs = left.unionByName(right).repartition("tile", "block").sortWithinPartitions("tile", "block", "side")
    return pairs.mapInArrow(run, "a long, b long")


def _classes(found: DataFrame, first: Column, radius: int) -> DataFrame:
    """fp, first (the least ``first`` of its component), group_size for each fingerprint."""
    nodes = stage(found.groupBy("fp").agg(F.min(first).alias("first")), "simhash-nodes")
    stars = components(links(nodes, radius))
    rooted = nodes.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("group_size"))
    return rooted.drop("first").join(groups, "root").select("fp", "first", "group_size")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id, group_size (distinct fingerprints) for each row."""
    found = stage(fingerprints(docs), "simhash")
    classes = _classes(found, F.col("doc_id"), radius).withColumnRenamed("first", "component_id")
    return found.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "group_size")


def near_survivors(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each group: that with the smallest doc_id, then digest of its text.

    A row without doc_id stays only where its group has no row with one. Rows with one doc_id
    and different texts are different documents.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    found = stage(fingerprints(docs, key=key), "simhash")
    best = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = stage(_classes(found, best, radius).select(F.col("first.key").alias("key")).distinct(), "near-kept")
    whole = docs.select(F.struct("*").alias("row"))
    keyed = whole.select("row", row_key(F.col("row.doc_id"), F.col("row.text")).alias("key"))
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
