"""The text operators as queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surgemark.llm import (
    bpe, divergence, exact_dedup, fingerprints, licenses, packing, periodic, quality, quality_rules, repeats,
    simhash, token_files, toxicity,
)
from surgemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def op7_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf, "documents"))


def op8_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf, "documents"))


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    files = token_files.write_files(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_files(files)


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edit_fingerprints(table(spark, sf, "documents"))


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.run_report(table(spark, sf, "documents"))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents"))


def op13_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_simhash": op2_simhash,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_licenses": op7_licenses,
    "op8_repeats": op8_repeats,
    "op9_token_files": op9_token_files,
    "op10_fingerprints": op10_fingerprints,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS kept,
               sha256(body) AS text_sha256
        FROM d
    """,
    "op12_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ),
        words AS (
            SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ),
        kept AS (
            SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 3
        ),
        held AS (
            SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ),
        langs AS (SELECT lang, sum(total) AS big, count(*) AS v FROM kept GROUP BY lang),
        sizes AS (
            SELECT g.lang, g.source, coalesce(s.size, 0) AS size, coalesce(big, 0) AS big, coalesce(v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM d) g
            LEFT JOIN (SELECT lang, source, sum(n) AS size FROM held GROUP BY ALL) s USING (lang, source)
            LEFT JOIN langs USING (lang)
        ),
        full_p AS (
            SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (size + v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (total + 1)) // (big + v)::HUGEINT AS q
            FROM sizes s JOIN kept k USING (lang) LEFT JOIN held USING (lang, source, term)
        ),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
            FROM full_p WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        ) WHERE part = 'pair' OR rank <= 200
    """,
    "op13_quality_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ),
        words AS (SELECT id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
        windows AS (
            SELECT id, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS gram
            FROM words WINDOW o AS (PARTITION BY id ORDER BY i)
        ),
        grams AS (SELECT id, i, count(*) OVER (PARTITION BY id, gram) AS times FROM windows WHERE gram IS NOT NULL),
        again AS (
            SELECT id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT id, i + unnest([0, 1, 2]) AS place FROM grams WHERE times > 1) GROUP BY id
        ),
        rows AS (
            SELECT id, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
            FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id
        ),
        m AS (
            SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(n_lines - n_distinct, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   coalesce(n_lines, 0) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_shouts,
                   length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
            FROM d LEFT JOIN again USING (id) LEFT JOIN rows USING (id)
        ),
        ledger AS (
            SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                   + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
                   + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT
                   + 32 * (5 * n_shouts > n_words)::BIGINT + 64 * (2 * n_capitals > word_chars)::BIGINT AS failures
            FROM m
        )
        SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM ledger
    """,
}
