"""BM25 ranking of documents for many queries, and keyword categories."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from surgemark.plans.staging import stage

K1, B = 1.5, 0.75
MIN_TOKEN = 3
TIE_DIGITS = 9

# Default category keywords and the category used when nothing matches.
DEFAULT_CATEGORY = "style"
CATEGORY_KEYWORDS = {
    "color": ["color", "palette", "hex", "#", "rgb"],
    "chart": ["chart", "graph", "visualization", "trend", "bar", "pie", "scatter", "heatmap",
              "funnel"],
    "landing": ["landing", "page", "cta", "conversion", "hero", "testimonial", "pricing",
                "section"],
    "product": ["saas", "ecommerce", "e-commerce", "fintech", "healthcare", "gaming",
                "portfolio", "crypto", "dashboard"],
    "style": ["style", "design", "ui", "minimalism", "glassmorphism", "neumorphism",
              "brutalism", "dark mode", "flat", "aurora", "prompt", "css", "implementation",
              "variable", "checklist", "tailwind"],
    "ux": ["ux", "usability", "accessibility", "wcag", "touch", "scroll", "animation",
           "keyboard", "navigation", "mobile"],
    "typography": ["font", "typography", "heading", "serif", "sans"],
    "icons": ["icon", "icons", "lucide", "heroicons", "symbol", "glyph", "pictogram",
              "svg icon"],
    "react": ["react", "next.js", "nextjs", "suspense", "memo", "usecallback", "useeffect",
              "rerender", "bundle", "waterfall", "barrel", "dynamic import", "rsc",
              "server component"],
    "web": ["aria", "focus", "outline", "semantic", "virtualize", "autocomplete", "form",
            "input type", "preconnect"],
}


def document_text(columns: Sequence[str]) -> Column:
    """Several columns as one searchable text."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores, at least three long."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[\p{{L}}\p{{N}}_]{{{MIN_TOKEN},}}"), F.lit(0))


def bm25(
    docs: DataFrame, queries: DataFrame, n: int, doc_id: str = "doc_id", query_id: str = "query_id",
    text: str = "text", staged: bool = True,
) -> DataFrame:
    """Best ``n`` documents of each query: (query_id, doc_id, score, rank).

    The query vocabulary is stored first, so the planner knows its size: as long as it can
    be sent everywhere, each document is tokenised once, and only its postings of query terms
    and one row with its length leave the map side, combined there. They are stored when
    ``staged``. Before scoring they are dealt by document, not by term, and meet the terms of all
    queries there (sent to them while these are few): a term that every document holds is spread
    over all tasks, and the scores of a document are summed where they arise. Ties go to the smaller document id, scores being compared at nine decimals
    so that the order terms are summed in cannot decide.
    """
    asked = (
        queries.select(F.col(query_id).alias("query_id"), F.explode(tokens(F.col(text))).alias("term"))
        .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("weight"))
    )
    # The empty term stands for the document itself and carries its length.
    vocabulary = asked.select("term").union(asked.sparkSession.range(1).select(F.lit(""))).distinct()
    if staged:
        vocabulary = stage(vocabulary, "vocabulary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words")
    ).select("doc_id", F.size("words").alias("len"), F.explode(F.array_append("words", "")).alias("term"))
    found = rows.join(vocabulary, "term", "left_semi").groupBy("term", "doc_id", "len").agg(
        F.count(F.lit(1)).alias("tf"))
    if staged:
        found = stage(found, "postings")
    totals = found.where("term = ''").agg(
        F.struct(F.count(F.lit(1)).cast("double").alias("n"), F.avg("len").alias("avg_len"))
    )
    postings = found.where("term <> ''")
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = (
        asked.join(frequency, "term")
        .withColumn("_t", totals.scalar())
        .withColumn("idf", F.log((F.col("_t.n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0))
        .select("query_id", "term", "weight", "idf", F.col("_t.avg_len").alias("avg_len"))
    )
    if staged:
        terms = stage(terms, "terms")
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("len") / F.col("avg_len"))
    part = F.col("weight") * F.col("idf") * F.col("tf") * F.lit(K1 + 1) / (F.col("tf") + norm)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    return (
        postings.repartition("doc_id").join(terms, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(part).alias("_exact"))
        .where("_exact > 0")
        .withColumn("score", F.round("_exact", TIE_DIGITS))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select("query_id", "doc_id", "score", "rank")
    )


def keyword_category(
    docs: DataFrame, text: str = "text", rules: Mapping[str, Sequence[str]] = CATEGORY_KEYWORDS,
    default: str = DEFAULT_CATEGORY,
) -> DataFrame:
    """Category with the most keywords contained in the text.

    Each text is read once by an automaton of all keywords, so the cost does not follow their
    number. Ties go to the category listed first, no hit and a null text to ``default``.
    """
    places: dict[str, list[int]] = {}
    for i, words in enumerate(rules.values()):
        for word in words:
            places.setdefault(word, []).append(i)
    n = len(rules)

    @F.pandas_udf("array<int>")
    def hits_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word in filter(None, places):
            automaton.add_word(word, word)
        automaton.make_automaton()

        def hits(content: str | None) -> list[int] | None:
            if content is None:
                return None
            out = [0] * n
            found = {word for _, word in automaton.iter(content)} if len(automaton) else set()
            # The empty keyword is in every text.
            for word in found | ({""} & places.keys()):
                for i in places[word]:
                    out[i] += 1
            return out

        for batch in batches:
            yield batch.map(hits)

    scored = hits_of(F.lower(F.col(text)))
    return (
        docs.withColumn("_hits", scored)
        .withColumn("hits", F.array_max("_hits"))
        .withColumn(
            "category",
            F.when(F.col("hits") > 0, F.element_at(
                F.array(*[F.lit(c) for c in rules]),
                F.array_position("_hits", F.col("hits")).cast("int"),
            )).otherwise(F.lit(default)),
        )
        .drop("_hits")
    )
