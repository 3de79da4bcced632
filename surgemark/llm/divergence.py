r"""Audit of how the sources of a language differ from each other and from the language.

Terms are runs of ASCII letters (lower-cased) and of any characters beyond ASCII. A language
keeps the V terms that at least ``LEAST`` of its documents hold. A group (language, source), and
the language itself, gives each kept term that it holds ``count`` times the weight

    p = 1 + floor(10 ** 9 * (count + 1) / (N + V)),   N its sum of counts,

and two weights p, q of a term differ by f = floor((p - q) ** 2 / q). All numbers are whole.

Terms of a group that stand out against its language (``term`` rows, p over q, the ``TOP``
greatest f) by dominance skybands. f grows with the group's count and falls with the
language's, so a term cannot be among the k first if k others have a count at least as high, a
language count at most as high, and an earlier place in UTF-8 order. Each partition goes through
its terms in the order of these three and retains those that fewer than k retained ones dominate;
the retained are merged in the same way, dealt by a salt, and only then is f worked out and ranked.

Divergence of two sources of one language (``pair`` rows): the sum of f over all kept terms.
Most groups lack most terms, and for a lacking term the weight is one number, p0. So the sum
is V * f(p0, p0') plus what each histogram of weights adds against the other group's p0,
plus a correction for terms that both hold, summed up inside tasks before it is shuffled.

Texts are counted in the task that reads them; counts of a group and term are combined there
and again before anything is joined, so a source with a third of all rows is spread out.

Odd input: null text, lang and source are empty ones; a group without terms has its rows of
part ``pair`` and none of ``term``; a language without kept terms has pair values of zero; a
language with one source has no pairs; rows repeated count each; any length works; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.llm.common import shuffle_partitions, text_or_empty
from surgemark.plans.staging import stage

LEAST = 3                     # documents of a language that hold a kept term
TOP = 200                     # terms ranked for each group
SCALE = 1_000_000_000
SMALL = 9_000_000_000         # a count below it fits a long when multiplied by SCALE
HELD = 400_000                # counts that a task holds before it passes them on
BLOCK = 256                   # terms compared with the retained ones at a time
SALTS = 16                    # parts in which skybands are merged

LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
COUNTS = "lang string, source string, term binary, n long, docs long"
BAND = "lang string, source string, n long, total long, term binary"
PART = "lang string, source string, item string, value long"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for (_, k), c in zip(fields, columns)],
        names=[n for n, _ in fields])


# --- counts ----------------------------------------------------------------------------

def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (uses), docs (documents), combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (uses, holding) in held.items():
                yield _batch(COUNTS, [lang] * len(uses), [source] * len(uses), list(uses), list(uses.values()),
                             [holding[t] for t in uses])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                terms = text.as_py().translate(LETTERS).split()
                uses, holding = held[lang, source]
                uses.update(terms)
                holding.update(set(terms))
            if sum(len(uses) for uses, _ in held.values()) > HELD:
                yield from passed_on()
        yield from passed_on()

    rows = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"),
                       text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n, total (uses in the language) and once (one row of each lang, term)."""
    of_term = Window.partitionBy("lang", "term")
    return (
        term_counts(docs).withColumn("total", F.sum("n").over(of_term))
        .withColumn("holding", F.sum("docs").over(of_term))
        .withColumn("once", F.col("source") == F.min("source").over(of_term))
        .where(F.col("holding") >= least).select("lang", "source", "term", "n", "total", "once")
    )


def weight(count: Column, total: Column, vocabulary: Column) -> Column:
    """p, exact for counts of any size; decimals only where a count times ``SCALE`` is no long."""
    whole = lambda c: c.cast("decimal(20,0)")
    large = F.call_function("div", whole(count + 1) * F.lit(SCALE), whole(total + vocabulary)).cast("long")
    small = F.call_function("div", (count + 1).cast("long") * F.lit(SCALE).cast("long"), total + vocabulary)
    return 1 + F.when(count < SMALL, small).otherwise(large)


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source of every row, with size (N), lang_size, vocabulary (V), and absent (p0)."""
    every = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("once").alias("terms"))
    langs = sizes.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.sum("terms").alias("vocabulary"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        every.join(sizes.drop("terms"), ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", zero("size"), zero("lang_size"), zero("vocabulary"))
        .withColumn("absent", F.when(F.col("vocabulary") > 0, weight(F.lit(0), F.col("size"), F.col("vocabulary"))))
    )


# --- terms: dominance skybands -----------------------------------------------------------

class Skyband:
    """Retained terms of one group. Terms come by falling count, rising total, and UTF-8."""

    def __init__(self, k: int):
        self.k = k
        self.terms: list[bytes] = []              # retained, in UTF-8 order
        self.totals = np.zeros(0, np.int64)       # of the retained, in that order

    def _above(self, some: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many retained ones dominate each: a table of the retained by the first of the given,
        in order of place and in order of total, that they stand before; then its running sums."""
        n = len(some) + 1
        by_place, by_total = np.argsort(place, kind="stable"), np.argsort(some, kind="stable")
        first_place = np.searchsorted(place[by_place], np.arange(len(self.totals)), side="right")
        first_total = np.searchsorted(some[by_total], self.totals, side="left")
        table = np.bincount(first_place * n + first_total, minlength=n * n).reshape(n, n)
        table = table.cumsum(axis=0).cumsum(axis=1)
        at_place, at_total = np.empty(n - 1, np.int64), np.empty(n - 1, np.int64)
        at_place[by_place] = at_total[by_total] = np.arange(n - 1)
        return table[at_place, at_total]

    def retain(self, totals: np.ndarray, terms: list[bytes]) -> list[int]:
        """Places of the next terms that fewer than ``k`` retained ones dominate."""
        out: list[int] = []
        for at in range(0, len(terms), BLOCK):
            some, names = totals[at:at + BLOCK], terms[at:at + BLOCK]
            place = np.array([bisect_right(self.terms, t) for t in names])
            above = self._above(some, place)
            rank = np.empty(len(names), np.int64)
            rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
            under = np.tril((some <= some[:, None]) & (rank < rank[:, None]))
            sure = above + under.sum(axis=1) < self.k
            taken = sure & (above < self.k)
            for i in np.flatnonzero(~sure & (above < self.k)).tolist():
                taken[i] = above[i] + (under[i] & taken)[:i].sum() < self.k
            new = np.flatnonzero(taken).tolist()
            if new:
                order = sorted(new, key=names.__getitem__)
                self.totals = np.insert(self.totals, place[order], some[order])
                for i in order:
                    self.terms.insert(bisect_right(self.terms, names[i]), names[i])
                out += [at + i for i in new]
        return out


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of ``BAND`` rows those that fewer than k others of their group and partition dominate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Skyband(k)
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, totals = batch.column(4).to_pylist(), batch.column(3).to_numpy()
            codes = [batch.column(i).dictionary_encode().indices.to_numpy() for i in (0, 1)]
            edges = [0, *(np.flatnonzero((np.diff(codes[0]) != 0) | (np.diff(codes[1]) != 0)) + 1).tolist(), len(terms)]
            kept: list[int] = []
            for lo, hi in zip(edges, edges[1:]):
                if lo < hi:
                    key = (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py())
                    if key != group:
                        group, band = key, Skyband(k)
                    kept += [lo + i for i in band.retain(totals[lo:hi], terms[lo:hi])]
            if kept:
                yield batch.take(pa.array(kept))

    ordered = rows.select(*[f.split()[0] for f in BAND.split(", ")]).sortWithinPartitions(
        "lang", "source", F.desc("n"), "total", "term")
    return ordered.mapInArrow(run, BAND)


def telling_terms(kept: DataFrame, of: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the terms that stand out in each group."""
    parts = shuffle_partitions(kept.sparkSession)
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS))
    merged = skybands(skybands(kept, top).repartition(parts, "lang", "source", salt), top)
    p = weight(F.col("n"), F.col("size"), F.col("vocabulary"))
    q = weight(F.col("total"), F.col("lang_size"), F.col("vocabulary"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return (
        merged.join(of, ["lang", "source"]).withColumn("p", p).withColumn("q", q).where("p > q")
        .withColumn("value", difference(F.col("p"), F.col("q")))
        .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
        .select("lang", "source", F.col("term").cast("string").alias("item"), "value", "rank")
    )


# --- pairs -----------------------------------------------------------------------------------

def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def shared_terms(weighted: DataFrame) -> DataFrame:
    """``PART`` rows that correct the sums of two sources for the terms that both hold.

    ``weighted``: lang, source, term, p, absent. A partition holds all rows of its terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = defaultdict(int)
        waiting: list[pa.RecordBatch] = []

        def add(rows: pa.Table) -> None:
            names, codes = [], []
            for c in ("lang", "source"):
                coded = rows.column(c).combine_chunks().dictionary_encode()
                names.append(coded.dictionary.to_pylist())
                codes.append(coded.indices.to_numpy().astype(np.int64))
            (langs, sources), (lang, source) = names, codes
            term, p, absent = (rows.column(c).to_numpy() for c in ("key", "p", "absent"))
            for lag in range(1, len(term)):
                a = np.flatnonzero(term[lag:] == term[:-lag])
                if not len(a):
                    break
                for x, y in ((a, a + lag), (a + lag, a)):
                    value = _f(p[x], p[y]) - _f(p[x], absent[y]) - _f(absent[x], p[y]) + _f(absent[x], absent[y])
                    pair = (lang[x] * len(sources) + source[x]) * len(sources) + source[y]
                    order = np.argsort(pair, kind="stable")
                    first = np.flatnonzero(np.diff(pair[order], prepend=-1))
                    for k, v in zip(pair[order][first].tolist(), np.add.reduceat(value[order], first).tolist()):
                        k, them = divmod(k, len(sources))
                        sums[langs[k // len(sources)], sources[k % len(sources)], sources[them]] += v

        def passed_on() -> pa.RecordBatch:
            out = _batch(PART, *(zip(*[(*k, v) for k, v in sums.items()]) if sums else [[]] * 4))
            sums.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last term may go on in the next batch.
            key = batch.column(2)
            last = int(np.argmax(key.to_numpy() == key[batch.num_rows - 1].as_py()))
            if last or (waiting and waiting[-1].column(2)[0].as_py() != key[0].as_py()):
                add(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
                waiting = []
            waiting.append(batch.slice(last))
            if len(sums) > HELD:
                yield passed_on()
        if waiting:
            add(pa.Table.from_batches(waiting))
        if sums:
            yield passed_on()

    parts = shuffle_partitions(weighted.sparkSession)
    # Terms are told apart by their place in the order of the partition.
    line = Window.partitionBy("lang", "term").orderBy("source")
    rows = weighted.repartition(parts, "lang", "term").withColumn("place", F.row_number().over(line)).select(
        "lang", "source",
        (F.monotonically_increasing_id() - F.col("place")).alias("key"), "p", "absent")
    return rows.mapInArrow(run, PART)


def absent_terms(weighted: DataFrame, of: DataFrame) -> DataFrame:
    """``PART`` rows of all pairs: sums as if no term were held by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = [o["source"] for o in row["others"]]
                if not row["vocabulary"]:
                    ahead = behind = np.zeros(len(names), np.int64)
                else:
                    other = np.array([o["absent"] for o in row["others"]], np.int64)
                    own = np.int64(row["absent"])
                    ahead, behind = row["vocabulary"] * _f(own, other), np.zeros(len(names), np.int64)
                    for h in row["held"] or []:
                        p, n = np.int64(h["p"]), h["n"]
                        ahead = ahead + n * (_f(p, other) - _f(own, other))
                        behind = behind + n * (_f(other, p) - _f(other, own))
                there = [i for i, s in enumerate(names) if s != row["source"]]
                lang, me = [row["lang"]] * len(there), [row["source"]] * len(there)
                them = [names[i] for i in there]
                yield _batch(PART, lang, me, them, ahead[there])
                yield _batch(PART, lang, them, me, behind[there])

    held = weighted.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n")).groupBy("lang", "source").agg(
        F.collect_list(F.struct("p", "n")).alias("held"))
    others = of.groupBy("lang").agg(F.collect_list(F.struct("source", "absent")).alias("others"))
    rows = of.join(held, ["lang", "source"], "left").join(others, "lang").select(
        "lang", "source", "vocabulary", "absent", "held", "others")
    return rows.mapInArrow(run, PART)


def source_pairs(kept: DataFrame, of: DataFrame) -> DataFrame:
    """lang, source, item (another source), value, rank."""
    weighted = kept.join(of, ["lang", "source"]).select(
        "lang", "source", "term", weight(F.col("n"), F.col("size"), F.col("vocabulary")).alias("p"), "absent")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        absent_terms(weighted, of).unionByName(shared_terms(weighted))
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(first))
    )


def divergence(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of each group's pairs and telling terms."""
    kept = stage(kept_counts(docs), "divergence-terms")
    of = stage(groups(docs, kept).coalesce(1), "divergence-groups")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(kept, of).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(telling_terms(kept, of, top).withColumn("part", F.lit("term")).select(columns))
