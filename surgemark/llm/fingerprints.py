"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph (a line) hashes to a wide vector: 128 lanes, each the sum of +1 or -1 for the
paragraph itself and for each run of four words inside it, taken from the bits of two
64-bit hashes. A fingerprint is the lane-wise sum over all paragraphs modulo 2^16. Hence

* the order of paragraphs does not matter, and equal texts have equal fingerprints;
* ``add`` and ``subtract`` insert and delete paragraphs without reading the rest;
* lanes are near zero for unrelated texts, so the cosine of two fingerprints estimates
  how much of the two multisets agrees (standard error about 0.09).

Internally a lane is counted as the number of set bits, two 32-bit counts to a long, beside
the number of pieces n; the signed lane is 2 * count - n. Both are exact below 2^31 pieces.

Only built-in column functions are used. Odd input: a null text is an empty text (one empty
paragraph); any length works; rows repeated with one doc_id are ordered by text; a null
doc_id sorts after all ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.llm.common import shuffle_partitions, text_or_empty

LANES = 128
_WORDS = 64                               # longs with two lanes each
_PAIR = 0x0000000100000001
# Four words of a line; runs start at the line's first word.
CHUNK = r"[^\x20\x09-\x0D]+(?:[\x20\x09\x0B\x0C\x0D]+[^\x20\x09-\x0D]+){0,3}"


def pieces(text: Column) -> Column:
    """The hashed parts of a text, paragraph by paragraph; depends on the paragraphs only."""
    lines = F.transform(F.split(text, "\n", -1), lambda line: F.concat(F.lit("\n"), line))
    return F.concat(lines, F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)))


def _counts(piece: Column) -> list[Column]:
    """Aggregates: ``_WORDS`` longs with two lane counts each."""
    hashes = [F.xxhash64(F.lit(seed), piece) for seed in (1, 2)]
    return [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_PAIR))) for h in hashes for j in range(32)]


def counts(piece: Column) -> Column:
    """Aggregate the vector of all pieces in a group: array of 64 packed counts and n."""
    return F.array(*_counts(piece), F.count(piece))


def lanes(vector: Column) -> Column:
    """The 128 signed lanes modulo 2^16 as an array of ints in [-32768, 32767]."""
    n = F.element_at(vector, -1)
    packed = F.slice(vector, 1, _WORDS)

    def signed(count: Column) -> Column:
        return F.pmod(2 * count - n + 32768, F.lit(65536)) - 32768

    return F.flatten(F.transform(packed, lambda w: F.array(
        signed(F.shiftrightunsigned(w, 32)), signed(w.bitwiseAND(F.lit(0xFFFFFFFF))))))


def encode(lane_array: Column) -> Column:
    """Lanes as text: four hex digits each."""
    return F.array_join(F.transform(lane_array, lambda x: F.lpad(F.lower(F.hex(F.pmod(x, F.lit(65536)))), 4, "0")), "")


def _wrapped(x: Column) -> Column:
    return F.pmod(x + 32768, F.lit(65536)) - 32768


def add(a: Column, b: Column) -> Column:
    """Fingerprint lanes of the union of two multisets of paragraphs."""
    return F.zip_with(a, b, lambda x, y: _wrapped(x + y))


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint lanes after deleting the paragraphs of ``b`` from ``a``."""
    return F.zip_with(a, b, lambda x, y: _wrapped(x - y))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two lane arrays, 1 for equal ones, never below 0."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a) * dot(b, b))
    value = F.when(a == b, F.lit(1.0)).when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fingerprint: for each group of rows with equal ``keys``."""
    rows = docs.select(*keys, F.explode(pieces(text_or_empty())).alias("piece"))
    return rows.groupBy(*keys).agg(counts(F.col("piece")).alias("v")).select(
        *keys, encode(lanes(F.col("v"))).alias("fingerprint"))


def _bucket(order: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``order``; looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def literal(values):
        return F.array(*[F.lit(v).cast("long") for v in values])

    last, fine = literal([b[-1] for b in blocks]), F.array(*[literal(b) for b in blocks])
    block = F.size(F.filter(last, lambda b: b <= order))
    inside = F.size(F.filter(F.get(fine, block), lambda b: b <= order))
    return block * step + F.coalesce(F.when(inside >= 0, inside), F.lit(0))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, ghost, rn, doc_id, text, next_text, in ascending doc_id order over all rows.

    The ids are cut into ranges of about equal size, and each range is ordered by itself.
    The first row of a range is also sent to the range before it, as a ghost; the very
    first row follows the very last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn(
        "ord", F.coalesce("doc_id", F.lit(2**63 - 1)))
    cuts = rows.agg(F.percentile_approx("ord", [i / buckets for i in range(1, buckets)] or [0.5],
                                        10 * buckets).alias("q")).first()["q"]
    bounds = sorted(set(cuts or [])) if buckets > 1 else []
    rows = rows.withColumn("bucket", _bucket(F.col("ord"), bounds))
    firsts = sorted((r["bucket"], r["first"]) for r in rows.groupBy("bucket").agg(F.min("ord").alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    if before:
        starts = F.col("ord").isin(list(before))
        source = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
        target = F.when(starts, F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("ghost")),
            F.struct(source[F.col("ord")].alias("bucket"), F.lit(True).alias("ghost")),
        )).otherwise(F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost"))))
    else:
        target = F.array(F.struct(F.col("bucket"), F.lit(False).alias("ghost")))
    placed = rows.select("doc_id", "ord", "text", F.explode(target).alias("t")).select(
        "doc_id", "ord", "text", F.col("t.bucket").alias("bucket"), F.col("t.ghost").alias("ghost"))
    w = Window.partitionBy("bucket").orderBy("ghost", F.col("ord"), "text")
    return placed.select("bucket", "ghost", "doc_id", "text", F.row_number().over(w).alias("rn"),
                         F.lead("text").over(w).alias("next_text"))


def edit_fingerprints(docs: DataFrame, *, buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited text replaces the last floor(n/2) code points by as many of the next
    document's first (all of them, if it has fewer).
    """
    buckets = buckets or 4 * shuffle_partitions(docs.sparkSession)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), n - half), F.left(F.coalesce("next_text", F.lit("")), half))
    rows = with_next(docs, buckets).select(
        "bucket", "ghost", "rn", "doc_id", n.alias("n_chars"), "text", edited.alias("edited")).withColumn(
        "edited_sha256", F.sha2("edited", 256))
    key = ["bucket", "ghost", "rn", "doc_id", "n_chars", "edited_sha256"]
    parts = rows.select(*key, F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("x"))
    vectors = (
        parts.select(*key, F.col("x.kind").alias("kind"), F.explode(pieces(F.col("x.t"))).alias("piece"))
        .groupBy(*key, "kind").agg(counts(F.col("piece")).alias("v"))
        .groupBy(*key).agg(*[F.first(F.when(F.col("kind") == k, F.col("v")), ignorenulls=True).alias(f"v{k}")
                             for k in (0, 1)])
        .select(*key, lanes(F.col("v0")).alias("own"), lanes(F.col("v1")).alias("changed"))
    )
    w = Window.partitionBy("bucket").orderBy("ghost", "rn")
    return (
        vectors.withColumn("following", F.lead("own").over(w)).where(~F.col("ghost"))
        .select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                encode(F.col("own")).alias("fingerprint"), encode(F.col("changed")).alias("edited_fingerprint"),
                likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                likeness(F.col("own"), F.col("following")).alias("near_next"))
    )
