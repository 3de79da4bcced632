"""Exact deduplication by skew-safe combining.

Texts are equal when identical after deleting the characters ``[\x20\x09-\x0D]``; a null
text counts as empty. The row with the most code points stays, then the smallest doc_id.

1. Local: rows of one task with the same digest and the same normalised text are combined
   before anything is sent (the map side of the aggregation).
2. Salted: what is left of a digest meets in one of several groups, by the task it came
   from, so a text that a third of all rows repeat arrives in several places.
3. Global: one winner for each salt is combined to the final winner.

Every stage groups by the digest and by the full normalised text, so two texts with one
digest stay apart. Documents then find their winner by digest; where one digest stands for
several texts, those documents are matched by their full text.

Results for odd input: a null text is an empty text; a null doc_id sorts after every other;
rows repeated with the same doc_id and length count as one document each, and only one of
them is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import text_or_empty
from surgemark.plans.staging import stage

BLANKS = " \t\n\x0b\x0c\r"
_SPAN = "20000000000000000000"       # above 2^64, the number of ids
_LOWEST = "9223372036854775808"      # 2^63


def normalised(text: Column) -> Column:
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _dec(value: str) -> Column:
    return F.lit(value).cast("decimal(38,0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """One number that is largest for the row that stays; null ids come last."""
    offset = F.coalesce(doc_id.cast("decimal(38,0)") + _dec(_LOWEST), _dec("18446744073709551616"))
    value = n_chars.cast("decimal(38,0)") * _dec(_SPAN) + (_dec(_SPAN) - 1 - offset)
    return value.cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    offset = _dec(_SPAN) - 1 - rank % _dec(_SPAN)
    return F.when(offset < _dec("18446744073709551616"), (offset - _dec(_LOWEST)).cast("long"))


def _chars_of(rank: Column) -> Column:
    return ((rank - rank % _dec(_SPAN)) / _dec(_SPAN)).cast("int")


def _keys(text: Column, doc_id: Column, digest) -> list[Column]:
    body = normalised(text)
    sha = F.sha2(body, 256)
    return [doc_id.cast("long").alias("doc_id"), F.length(text).alias("n_chars"), body.alias("body"),
            (digest(body) if digest else sha).alias("digest"), sha.alias("sha")]


def _combine(rows: DataFrame, salts: int) -> DataFrame:
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "body", "salt")
        .agg(F.max(_rank(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("size"))
    )
    return salted.groupBy("digest", "body").agg(F.max("best").alias("best"), F.sum("size").alias("group_size"))


def _winners(docs: DataFrame, salts: int, digest) -> DataFrame:
    """doc_id, sha, n_chars, rows of that kind, and the winner and size of their group."""
    keyed = docs.select(_keys(text_or_empty(), F.col("doc_id"), digest))
    groups = stage(_combine(keyed, salts).drop("body"), "exact-groups")
    per_digest = groups.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("best").alias("best"), F.max("group_size").alias("group_size"))
    kind = ["doc_id", "digest", "sha", "n_chars"]
    found = (
        keyed.groupBy(kind).agg(F.count(F.lit(1)).alias("rows"))
        .join(per_digest.where("texts = 1").drop("texts"), "digest")
    )
    clashes = per_digest.where("texts > 1").select("digest")
    if not clashes.isEmpty():
        rest = keyed.join(clashes, "digest", "left_semi")
        found = found.unionByName(
            rest.groupBy(*kind, "body").agg(F.count(F.lit(1)).alias("rows"))
            .join(_combine(rest, salts), ["digest", "body"]).drop("body"))
    wins = (F.col("n_chars") == _chars_of(F.col("best"))) & F.col("doc_id").eqNullSafe(_id_of(F.col("best")))
    return found.select("doc_id", "sha", "n_chars", "rows", "group_size",
                        _id_of(F.col("best")).alias("keep_id"), wins.alias("wins"))


def exact_dedup(docs: DataFrame, *, salts: int = 16, digest=None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` maps the normalised text column to the grouping key (SHA-256 by default);
    a weak one changes the cost, never the answer.
    """
    one_each = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")
    return _winners(docs, salts, digest).select("*", one_each).select(
        "doc_id", "keep_id", "group_size", (F.col("wins") & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def exact_survivors(docs: DataFrame, *, salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    kept = _winners(docs, salts, None).where("wins").select("doc_id", "sha", "n_chars")
    whole = docs.select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    keyed = whole.select("row", *[k for k in _keys(text, F.col("row.doc_id"), None)]).drop("body", "digest")
    same = (keyed.doc_id.eqNullSafe(kept.doc_id)) & (keyed.sha == kept.sha) & (keyed.n_chars == kept.n_chars)
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "sha", "n_chars"]).select("row.*")
