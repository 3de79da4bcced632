"""Long repeated passages, found by common-prefix interval trees of a suffix array.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else is a repeat;
``length`` and ``words`` set other limits. With ``words``, so is every passage of as many
blank-separated words that is met again, however short in bytes: the method runs once more
over the texts' words, each coded as a hash of ``CODE`` bytes.

1. Anchors. Each window of ``LENGTH`` bytes picks the smallest of the hashes of its
   ``gram``-byte strings. Equal windows pick the same string at the same offset, so windows
   are compared only where they hang on equal anchors; one anchor serves a run of windows.
2. Whole runs. Runs with the same bytes around the same anchor (128-bit digest) are
   repeats of each other as they stand.
3. Buckets. Different runs that share an anchor are suffixes with a common prefix. Spark
   sorts a bucket by the text from the anchor on, which is its part of the suffix array;
   neighbours' common prefixes complete it. A scan with a stack yields the common-prefix
   intervals. In each, the same scan over the members' sorted left contexts yields groups
   that agree to the left as well. A group is a maximal repeat if its members differ in what
   follows on both sides; where the match reaches ``LENGTH``, all of them are marked.
4. Full buckets. A bucket of more than ``BUCKET`` runs is not gathered. Its runs are cut by
   window offset on a fixed grid that halves in each round; windows of one cell can only
   match where the text that they all share is equal, which is the new bucket key. Rounds
   end at single windows, where equal keys are equal windows. Steps 2 and 3 apply in each.

Anchors that make up more than a two-thousandth of all are dealt out by digest as well.

``maximal_repeats`` outputs the groups with all their occurrences. There a run with copies
stands twice in its bucket, so that a group of nothing but copies is found by the same scan,
and all rows of a full bucket go through the rounds. Groups are maximal within the stretch of
text that hangs on their anchor: longer repeats show as several groups that overlap.

Odd input: a null text is an empty text; texts under ``LENGTH`` bytes have no repeats;
longer ones are read in blocks; rows repeated with one doc_id and text repeat each other;
an empty table gives no rows; other columns are ignored, or returned unchanged by
``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from surgemark.llm.common import text_or_empty
from surgemark.plans.staging import stage

LENGTH = 400
CODE = 8                      # bytes of a word's hash
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BUCKET = 512                  # runs that one task compares with each other
BLOCK = 1 << 19               # windows of a text that are hashed at a time


def gram(length: int) -> int:
    """Bytes of an anchor; it has ``length - gram(length) + 1`` places in a window."""
    return max(1, length * 8 // 25)


# A run of windows: its row (a 128-bit digest of id and text), anchor and first and last
# window; the anchor's key, the digest of the run's bytes, and how often it is known to occur.
RUN = "k1 long, k2 long, x long, lo long, hi long, key1 long, key2 long, c1 long, c2 long, n long"


# --- anchors -------------------------------------------------------------------------

class GramHasher:
    """Hashes of all ``gram``-byte strings of a text block: prefix sums of a polynomial."""

    def __init__(self, size: int, gram: int):
        self.gram = gram
        rng = np.random.default_rng(400)
        base = np.uint64(6364136223846793005)
        inverse = np.uint64(pow(int(base), -1, 2**64))
        self.table = rng.integers(0, 2**64, 256, dtype=np.uint64)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:len(data)], out=sums[1:])
        h = (sums[self.gram:] - sums[:-self.gram]) * self.back[:len(data) - self.gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima inside blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, hasher: GramHasher, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """x, lo, hi, anchor hash: windows lo..hi (their starts) hang on the anchor at x."""
    place = np.uint64((1 << 20) - 1)
    for s in range(0, len(data) - length + 1, BLOCK):
        part = data[s:s + BLOCK + length - 1]
        h = hasher(part)
        ranked = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_min(ranked, length - hasher.gram + 1) & place).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [len(anchor)]]) - 1
        x = anchor[first]
        yield x + s, first + s, last + s, h[x].view(np.int64)


def merged(start: np.ndarray, end: np.ndarray, touching: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open spans; touching spans are one, if asked for."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] >= end[:-1] + touching])
    return start[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]


def _rows(schema: str, *columns) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(columns[0]), kinds[k]) if c is None else pa.array(c, kinds[k])
         for (_, k), c in zip(fields, columns)], names=[f[0] for f in fields])


def _settle(k: np.ndarray, x, lo, hi, key: np.ndarray, digests: list[bytes], length: int) -> Iterator[pa.RecordBatch]:
    """RUN rows; of runs met twice here, the first goes on and the spans of all are settled."""
    joined = b"".join(digests)
    c = np.frombuffer(joined, "<i8").reshape(-1, 2)
    _, first, group, count = np.unique(
        np.frombuffer(joined, "V16"), return_index=True, return_inverse=True, return_counts=True)
    times = np.minimum(count[group], 2)
    yield _rows(RUN, *(v[first] for v in (k[:, 0], k[:, 1], x, lo, hi, key[:, 0], key[:, 1], c[:, 0], c[:, 1], times)))
    twice = np.flatnonzero(times > 1)
    if len(twice):
        # One row after the other, far apart, so that spans merge within rows only.
        rows, row = np.unique(k[twice], axis=0, return_inverse=True)
        shift = row.ravel().astype(np.int64) << 40
        s, e = merged(lo[twice] + shift, hi[twice] + length + shift, touching=False)
        of = rows[s >> 40]
        yield _rows(RUN, of[:, 0], of[:, 1], None, s & (1 << 40) - 1, e & (1 << 40) - 1, None, None, None, None, None)


def anchors(docs: DataFrame, length: int, every: bool = False) -> DataFrame:
    """RUN rows of all texts (k1, k2, text). A row without key is a span lo..hi to remove.

    With ``every``, each run has its own row, and there are no spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        hasher = GramHasher(BLOCK + length, gram(length))
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                ids = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
                found, rows, digests = [], [], []
                for row, text in enumerate(batch.column(2)):
                    text = text.as_py()
                    for part in runs(np.frombuffer(text, np.uint8), hasher, length):
                        found.append(np.stack(part))
                        rows.append(np.full(len(part[0]), row))
                        digests += [digest(text[lo:hi + length], x - lo)
                                    for x, lo, hi in zip(*(c.tolist() for c in part[:3]))]
                if found:
                    x, lo, hi, h = np.concatenate(found, axis=1)
                    k, zero = ids[np.concatenate(rows)], np.zeros_like(h)
                    if every:
                        c = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                        yield _rows(RUN, k[:, 0], k[:, 1], x, lo, hi, h, zero, c[:, 0], c[:, 1], zero + 1)
                    else:
                        yield from _settle(k, x, lo, hi, np.stack([h, zero], axis=1), digests, length)

    return docs.mapInArrow(run, RUN)


# --- equal runs and buckets ------------------------------------------------------------

def classify(found: DataFrame) -> DataFrame:
    """RUN rows with ``times`` (rows of the same run) and ``size`` (different runs of the key).

    One row of a run is its ``first``. Keys with more than a two-thousandth of all rows, of
    which there are at most two thousand, are dealt out by digest; their size is not counted.
    """
    found = found.where("key1 is not null")
    total = found.count()
    counted = found.groupBy("key1", "key2").count().where(F.col("count") * 2000 > F.lit(total)).where("count > 1000")
    hot = F.broadcast(counted.select("key1", "key2", F.lit(True).alias("hot")))
    dealt = found.join(hot, ["key1", "key2"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod("c1", F.lit(512))).otherwise(0)).repartition("key1", "key2", "salt")
    same = Window.partitionBy("key1", "key2", "salt", "c1", "c2")
    key = Window.partitionBy("key1", "key2", "salt")
    return (
        dealt.withColumn("times", F.sum("n").over(same))
        .withColumn("first", F.row_number().over(same.orderBy("k1", "k2", "lo")) == 1)
        .withColumn("size", F.when(F.col("hot"), F.lit(2**40)).otherwise(F.sum(F.col("first").cast("long")).over(key)))
        .where("times > 1 or size > 1")
        .drop("hot", "salt")
    )


CONTEXT = "key1 long, key2 long, size long, times long, c1 long, c2 long, k1 long, k2 long, x long, lo long, hi long, back binary, ahead binary"


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes around each wanted run: backwards from its anchor, and from it onwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py()
                k = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                for r in batch.column(3)[row].as_py():
                    *known, x, lo, hi = r.values()
                    out.append((*known, *k, x, lo, hi, text[lo:x][::-1], text[x:hi + length]))
                if len(out) > 5000:
                    yield _rows(CONTEXT, *zip(*out))
                    out = []
            if out:
                yield _rows(CONTEXT, *zip(*out))

    per_row = wanted.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("key1", "key2", "size", "times", "c1", "c2", "x", "lo", "hi")).alias("wanted"))
    # Rows repeated with one id and text share k1 and k2; one of them is read.
    once = docs.join(per_row, ["k1", "k2"]).select("k1", "k2", "text", "wanted").dropDuplicates(["k1", "k2"])
    return once.mapInArrow(run, CONTEXT)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y))


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (depth, first, last) of a suffix array, children first.

    ``lcp[i]`` belongs to suffixes i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            height, first = stack.pop()
            yield height, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_groups(
    ahead: list[bytes], back: list[bytes], length: int = LENGTH,
) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
    """Maximal repeats of a bucket, interval by interval of the sorted ``ahead``.

    Yields the depth, the interval's members by left context, and the groups (reach, first,
    last) of neighbours among them. A group is all that hold one string, ``reach`` bytes
    before the anchor and ``depth`` after, ``length`` or more in all. To the left its members
    differ where the reach ends; to the right some must lie in different children of the
    interval, or else the group belongs to a deeper one.
    """
    n = len(ahead)
    lcp = np.array([common_prefix(ahead[i], ahead[i + 1]) for i in range(n - 1)], np.int64)
    order = sorted(range(n), key=back.__getitem__)
    left = np.array([0] + [common_prefix(back[a], back[b]) for a, b in zip(order, order[1:])])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    for depth, first, last in intervals(lcp.tolist()):
        members = first + np.argsort(place[first:last + 1])      # by left context
        at = place[members]
        # The common left context of neighbours: the least on the way from one to the next.
        agree = np.minimum.reduceat(left[:at[-1] + 1], at[:-1] + 1)
        if agree.max() + depth < length:
            continue
        forks = first + np.flatnonzero(lcp[first:last] == depth)      # where children meet
        groups = []
        for reach, a, b in intervals(agree.tolist()):
            if reach + depth >= length:
                part = members[a:b + 1]
                fork = np.searchsorted(forks, part.min())
                if fork < len(forks) and forks[fork] < part.max():
                    groups.append((reach, a, b))
        if groups:
            yield depth, members, groups


SPAN = "k1 long, k2 long, lo long, hi long"
GROUP = "group1 long, group2 long, n_bytes long, before long, key1 long, key2 long, c1 long, c2 long"


def _spans(group: list[tuple], length: int) -> list[tuple]:
    """SPAN rows of a bucket's runs (CONTEXT rows, sorted)."""
    out = []
    for depth, members, groups in repeat_groups([g[12] for g in group], [g[11] for g in group], length):
        reach = np.full(len(members), -1)
        for r, a, b in reversed(groups):          # the widest first
            reach[a:b + 1] = r
        for m, r in zip(members.tolist(), reach.tolist()):
            k1, k2, x, lo, hi = group[m][6:11]
            # Offsets of windows in the match, within this run.
            low, high = max(length - depth, x - hi), min(r, x - lo)
            if low <= high:
                out.append((k1, k2, x - high, x - low + length))
    return out


def _groups(group: list[tuple], length: int) -> list[tuple]:
    """GROUP rows of a bucket's runs (CONTEXT rows, sorted): each group's runs, once each."""
    import xxhash

    twice = [i for i, g in enumerate(group) for _ in range(min(g[3], 2))]
    back, ahead = ([group[i][c] for i in twice] for c in (11, 12))
    out = []
    for depth, members, groups in repeat_groups(ahead, back, length):
        for reach, a, b in groups:
            m = members[a]
            known = np.frombuffer(xxhash.xxh3_128_digest(back[m][:reach][::-1] + ahead[m][:depth]), "<i8").tolist()
            for i in sorted({twice[m] for m in members[a:b + 1].tolist()}):
                key1, key2, _, _, c1, c2 = group[i][:6]
                out.append((*known, reach + depth, reach, key1, key2, c1, c2))
    return out


def by_bucket(found: DataFrame, work, schema: str, length: int) -> DataFrame:
    """What ``work`` finds in buckets (CONTEXT rows) of at most ``BUCKET`` runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][:2] != row[:2]:
                    out += work(group, length)
                    group = []
                # Rows repeated with one id and text bring the same run again.
                if not (group and group[-1][6:9] == row[6:9]):
                    group.append(row)
            if out:
                yield _rows(schema, *zip(*out))
        if group and (out := work(group, length)):
            yield _rows(schema, *zip(*out))

    dealt = found.repartition("key1", "key2").sortWithinPartitions("key1", "key2", "ahead", "k1", "k2", "x")
    return dealt.mapInArrow(run, schema)


def halves(found: DataFrame, width: int, length: int) -> DataFrame:
    """Cut the runs of full buckets on a grid of ``width`` offsets: RUN rows with their bytes."""

    offsets = length - gram(length) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            out: list[tuple] = []
            for key1, key2, _, _, _, _, k1, k2, x, lo, hi, back, ahead in zip(*(c.to_pylist() for c in batch.columns)):
                for cell in range((x - hi) // width, (x - lo) // width + 1):
                    g0, g1 = cell * width, min((cell + 1) * width, offsets) - 1
                    d0, d1 = max(g0, x - hi), min(g1, x - lo)
                    b, a = back[:d1], ahead[:length - d0]
                    core = digest(back[:g0][::-1] + ahead[:length - g1] + b"%d,%d" % (g0, key2), key1 % 2**64)
                    own = digest(b[::-1] + a, d1 << 20 | d0)
                    out.append((k1, k2, x, x - d1, x - d0,
                                *np.frombuffer(core, "<i8").tolist(), *np.frombuffer(own, "<i8").tolist(), 1, b, a))
            if out:
                yield _rows(RUN + ", back binary, ahead binary", *zip(*out))

    return found.mapInArrow(run, RUN + ", back binary, ahead binary")


def rounds(
    docs: DataFrame, found: DataFrame, length: int, every: bool = False,
) -> Iterator[tuple[DataFrame, DataFrame, int]]:
    """Classes of runs and the buckets to compare, and the grid's width for the next round.

    Of equal runs one is compared; in full buckets ``every`` one goes on, if asked for.
    """
    wanted = "size > 1 and (first or size > %d)" % BUCKET if every else "size > 1 and first"
    width = 1 << (length - gram(length)).bit_length()
    seen = stage(classify(found), "repeat-classes")
    compared = stage(contexts(docs, seen.where(wanted), length), "repeat-contexts")
    while True:
        full = compared.where(F.col("size") > BUCKET)
        width //= 2
        more = width > 0 and not full.isEmpty()
        yield seen, compared.where(F.col("size") <= BUCKET), width if more else 0
        if not more:
            return
        seen = stage(classify(stage(halves(full, width, length), "repeat-halves")), "repeat-classes")
        compared = seen.where(wanted).select(*[f.split()[0] for f in CONTEXT.split(", ")])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans k1, k2, lo, hi (end) of repeats in ``docs`` (k1, k2, text as bytes); may overlap."""
    found = stage(anchors(docs, length), "repeat-anchors")
    # Runs that occur twice are repeats; of those with one key and different bytes, one each is compared.
    spans = [found.where("key1 is null").select("k1", "k2", "lo", "hi")]
    for seen, buckets, _ in rounds(docs, found, length):
        spans.append(seen.where("times > 1").select("k1", "k2", "lo", (F.col("hi") + length).alias("hi")))
        spans.append(by_bucket(buckets, _spans, SPAN, length))
    return _union(spans)


# --- results ---------------------------------------------------------------------------

def _with_keys(docs: DataFrame) -> DataFrame:
    """row (all columns), k1, k2 (a digest of id and text), text (bytes)."""
    row = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return row.select("row", F.xxhash64("row.doc_id", text).alias("k1"),
                      F.xxhash64(F.lit(1), text, "row.doc_id").alias("k2"), text.cast("binary").alias("text"))


class Repeats(NamedTuple):
    """``groups``: group1, group2 (a digest), n_bytes, run1, run2, before; ``runs``: run1, run2, doc_id, anchor.

    A group occurs in each row of each of its runs, from ``anchor - before`` on.
    """
    groups: DataFrame
    runs: DataFrame

    def occurrences(self) -> DataFrame:
        """group1, group2, n_bytes, doc_id, start: one row for each occurrence of each group."""
        return self.groups.join(self.runs, ["run1", "run2"]).select(
            "group1", "group2", "n_bytes", "doc_id", (F.col("anchor") - F.col("before")).alias("start"))


def maximal_repeats(docs: DataFrame, length: int = LENGTH) -> Repeats:
    """Groups of equal strings of ``length`` bytes or more, in the bytes of each row's text, with
    all their occurrences. Groups hold classes of equal runs, so copies are not multiplied."""
    keyed = _with_keys(docs)
    texts = keyed.select("k1", "k2", "text")
    run = [F.xxhash64(F.lit(i), "key1", "key2", "c1", "c2").alias(f"run{i}") for i in (1, 2)]
    groups, runs, last = [], [], False
    found = stage(anchors(texts, length, every=True), "repeat-anchors")
    for seen, buckets, width in rounds(texts, found, length, every=True):
        groups.append(by_bucket(buckets, _groups, GROUP, length).select("group1", "group2", "n_bytes", "before", *run))
        # No other run has its key; in single windows, none can.
        alone = seen.where("first and times > 1").where(F.lit(True) if last else F.col("size") == 1)
        groups.append(alone.select(
            F.col("c1").alias("group1"), F.col("c2").alias("group2"), (F.col("hi") - F.col("lo") + length).alias("n_bytes"),
            (F.col("x") - F.col("lo")).alias("before"), *run))
        runs.append(seen.select(*run, "k1", "k2", F.col("x").alias("anchor")))
        last = width == 1
    ids = keyed.select("k1", "k2", F.col("row.doc_id").cast("long").alias("doc_id")).distinct()
    return Repeats(_union(groups), _union(runs).join(ids, ["k1", "k2"]).select("run1", "run2", "doc_id", "anchor"))


def coded(docs: DataFrame) -> DataFrame:
    """``docs`` (k1, k2, text as bytes) with each word coded in ``CODE`` bytes, and no blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = [b"".join(map(xxhash.xxh64_digest, t.as_py().split())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["k1", "k2", "text"])

    return docs.mapInArrow(run, "k1 long, k2 long, text binary")


def _spans_of(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """spans of each row (k1, k2) with repeats; ``word`` says that they are in coded words."""
    texts = docs.select("k1", "k2", "text")
    spans = repeated_spans(texts, length).withColumn("word", F.lit(False))
    if words:
        spans = spans.unionByName(repeated_spans(coded(texts), words * CODE).withColumn("word", F.lit(True)))
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi", "word")).alias("spans"))


def _kept(text: bytes, spans: list[dict] | None) -> tuple[list[bytes], int, int]:
    """The bytes that stay, in pieces; how many go, in how many runs."""
    if not spans:
        return [text], 0, 0
    lo, hi = ([x[c] for x in spans if not x["word"]] for c in ("lo", "hi"))
    if by_word := [x for x in spans if x["word"]]:
        place = [m.span() for m in WORD.finditer(text)]
        s, e = merged(np.array([x["lo"] for x in by_word]), np.array([x["hi"] for x in by_word]), touching=False)
        # Whole words only: a match may reach into the code of the next word by chance.
        for first, last in zip((-(-s // CODE)).tolist(), (e // CODE - 1).tolist()):
            lo.append(place[first][0])
            hi.append(place[last][1])
    s, e = merged(np.array(lo), np.array(hi))
    edges = [0, *np.stack([s, e], axis=1).ravel().tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2])], int((e - s).sum()), len(s)


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and text, what is left of each row's text.

    The digest is that of the remaining bytes; ``text`` leaves out characters cut in two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            sizes, gone, cuts, sha, left = [], [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                pieces, removed, n = _kept(text, spans.as_py())
                digest = hashlib.sha256()
                for piece in pieces:
                    digest.update(piece)
                sizes.append(len(text))
                gone.append(removed)
                cuts.append(n)
                sha.append(digest.hexdigest())
                left.append(b"".join(pieces).decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in (sizes, gone, cuts)), pa.array(sha, pa.string()),
                 pa.array(left, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    keyed = _with_keys(docs)
    rows = keyed.join(_spans_of(keyed), ["k1", "k2"], "left").select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` without the repeats in its texts; ``n_chars`` follows where there is one.

    Repeats have at least ``length`` bytes or, if given, at least ``words`` words.

    A character that is cut in two goes as a whole. Rows stay even if nothing is left; a
    null text stays null.
    """

    @F.pandas_udf("string")
    def keep(text, spans):
        return text.combine(spans, lambda t, s: b"".join(_kept(bytes(t), list(s) if s is not None else None)[0]).decode(errors="ignore"))

    keyed = _with_keys(docs)
    joined = keyed.join(_spans_of(keyed, length, words), ["k1", "k2"], "left")
    new = F.when(F.col("row.text").isNotNull(), F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(
        keep("text", "spans")))
    rows = joined.select("row", new.alias("text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return rows.select(columns)
