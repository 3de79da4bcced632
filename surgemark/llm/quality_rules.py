r"""Quality rules kept as a ledger of failure bits.

1. Ledger. Every rule is evaluated once for each document, by column expressions in one
   pass without a shuffle: the ledger holds what was measured and one number whose bit b is
   set where rule b fails. It can be stored; nothing later reads a text again.
2. Policies. A policy is a set of rules, named by a version, and so a mask of bits. A
   document passes where the failure bits and the mask have none in common.
3. Ablations. The ledger is counted by failure bits (combined before the shuffle; there are
   at most 2 ** rules such numbers, however many documents). What each rule of each policy
   rejects, alone or with others, follows from these counts by bitwise operations.

All rules compare whole numbers. Words are runs of ``[^\x20\x09-\x0D]``; repeated words are
those in windows of three words that are met twice or more in a text, found by sorting the
windows' hashes and then, of those with equal hashes, the windows themselves.

Odd input: null, empty and blank texts have no words, all measures zero, and fail ``short``;
any length works; rows repeated with one doc_id give one row each, a null doc_id too; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import text_or_empty
from surgemark.llm.exact_dedup import normalised

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_capitals")


def _c(name: str) -> Column:
    return F.col(name)


# Rule b has bit b. New rules go to the end, so that stored ledgers keep their meaning.
RULES: dict[str, Callable[[], Column]] = {
    "short": lambda: _c("n_words") < 50,
    "repeated_words": lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words"),
    "symbols": lambda: 10 * _c("n_symbols") > _c("n_words"),
    "duplicate_lines": lambda: 2 * _c("n_dup_lines") > _c("n_lines"),
    "word_length": lambda: (_c("word_chars") < 2 * _c("n_words")) | (_c("word_chars") > 15 * _c("n_words")),
    "shouts": lambda: 5 * _c("n_shouts") > _c("n_words"),
    "capitals": lambda: 2 * _c("n_capitals") > _c("word_chars"),
}
BASE = ("short", "repeated_words")
POLICIES: dict[str, Sequence[str]] = {
    "1": BASE,
    "2": (*BASE, "symbols", "duplicate_lines"),
    "3": (*BASE, "symbols", "duplicate_lines", "word_length", "shouts", "capitals"),
}
CURRENT = "3"


def mask(rules: Sequence[str]) -> int:
    places = list(RULES)
    return sum(1 << places.index(r) for r in set(rules))


# --- measures ------------------------------------------------------------------------

def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _met_twice(places: Column, key: Callable[[Column], Column]) -> Column:
    """Of ``places`` those whose key another of them has; ordered by key."""
    keyed = F.array_sort(F.transform(places, lambda i: F.struct(key(i).alias("key"), i.alias("i"))))
    twice = lambda all_: F.filter(all_, lambda x, j: (
        (x["key"] == F.get(all_, j - 1)["key"]) | (x["key"] == F.get(all_, j + 1)["key"])))
    return F.transform(let(keyed, twice), lambda x: x["i"])


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that are met twice or more, first ones included."""
    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(width)]

    def covered(places: Column) -> Column:
        # A window covers what the next one does not begin with.
        steps = F.transform(places, lambda i, j: F.least(
            F.lit(width), F.coalesce(F.get(places, j + 1) - i, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s)

    places = F.sequence(F.lit(0), F.size(words) - width)
    hashes = F.transform(places, lambda i: F.xxhash64(*window(i)))
    again = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(
        F.array_sort(_met_twice(_met_twice(places, lambda i: F.get(h, i)), lambda i: F.concat_ws(" ", *window(i)))),
        covered))
    return F.coalesce(F.when(F.size(words) >= width, let(hashes, again)), F.lit(0).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``MEASURES`` of each row's text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parts = texts.select(
        "doc_id", "text", F.array_remove(F.split("text", BLANK + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    whole = lambda c: c.cast("long")
    return parts.select(
        "doc_id", whole(F.size("words")).alias("n_words"), whole(F.length(normalised(F.col("text")))).alias("word_chars"),
        whole(F.regexp_count("text", F.lit(SYMBOLS))).alias("n_symbols"),
        whole(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        whole(F.size("lines")).alias("n_lines"),
        whole(F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).alias("n_shouts"),
        whole(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_capitals"))


# --- ledger, policies, ablations -------------------------------------------------------

def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, ``MEASURES`` and ``failures``, the bits of the rules that each row fails."""
    bits = [F.when(rule(), F.lit(1 << b)).otherwise(0) for b, rule in enumerate(RULES.values())]
    return measured(docs).withColumn("failures", reduce(Column.bitwiseOR, bits).cast("long"))


def fails(policy: Sequence[str]) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(policy))) != 0


def apply_policy(rows: DataFrame, policy: Sequence[str] = POLICIES[CURRENT], name: str = "kept") -> DataFrame:
    """A ledger with the verdict of a policy in the boolean column ``name``."""
    return rows.withColumn(name, ~fails(policy))


def ablations(rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """What each rule does in each policy: policy, rule, failed (documents), failed_alone (no
    other rule of the policy rejects them), kept, kept_without (the rule)."""
    counts = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    tried = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"),
                 F.lit(mask(rules)).cast("long").alias("mask"), F.lit(mask([r])).cast("long").alias("bit"))
        for v, rules in policies.items() for r in rules])
    hit = F.col("failures").bitwiseAND(F.col("t.mask"))
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long")
    return (
        counts.select("failures", "n", F.explode(tried).alias("t"))
        .groupBy("t.policy", "t.rule").agg(
            total(hit.bitwiseAND(F.col("t.bit")) != 0).alias("failed"),
            total(hit == F.col("t.bit")).alias("failed_alone"),
            total(hit == 0).alias("kept"),
            total((hit == 0) | (hit == F.col("t.bit"))).alias("kept_without"))
    )


def rule_report(docs: DataFrame) -> DataFrame:
    """The ledger with ``base_failed`` and the current policy's ``kept``."""
    rows = apply_policy(ledger(docs).withColumn("base_failed", fails(BASE)))
    return rows.withColumn("kept", F.col("kept") & ~F.col("base_failed"))
