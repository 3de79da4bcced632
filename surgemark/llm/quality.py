"""Quality by a sparse rule ensemble over text statistics.

1. ``STATISTICS`` of each whole text are taken in one pass and written to the shared folder.
2. A random forest is grown on labelled documents' statistics (never a held-out one; at most
   ``LABELLED`` of them, those with the smallest hash of their id). Every path from a root to
   an inner node or leaf is a rule: a conjunction of bounds on statistics.
3. A lasso logistic regression weighs the rules, and most weights come out as zero.
4. The rules that remain become column expressions, and the score is their weighted sum put
   through the logistic function, inside the JVM.

Odd input: null and empty texts have all statistics zero and are scored like any other; any
length works; rows repeated with one doc_id give one row each; conflicting labels count as
the smaller one, null labels not at all; without labels of both kinds every score is the
share of ones (0 without any); other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import held_out, text_or_empty
from surgemark.plans.staging import stage

LABELLED = 50_000
TREES, DEPTH = 16, 4
LASSO = 0.0005

STATISTICS = (
    "chars", "words", "mean_word", "longest_word", "distinct_words", "repeated_next", "top_word", "upper_words",
    "title_words", "digits", "exclamations", "bars", "symbols", "marked_words", "full_stops", "commas", "lines",
    "mean_line", "distinct_lines", "short_lines", "non_ascii", "brackets", "links",
)
SYMBOLS = "%$&#*@^~=+_\\"


def statistics(text: str) -> tuple[float, ...]:
    """The numbers named in ``STATISTICS``; shares are of characters, words or lines."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, chars = len(words), len(text)
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    sizes = [*map(len, words)]
    count = text.count
    symbols = sum(map(count, SYMBOLS))
    return (
        math.log1p(chars), math.log1p(n), sum(sizes) / n, max(sizes), len(counts) / n,
        sum(map(str.__eq__, words, words[1:])) / n, max(counts.values()) / n,
        sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
        sum(map(count, "0123456789")) / chars, count("!") / n, count("|") / n, symbols / n,
        sum(not w[-1].isalnum() for w in words) / n, count(".") / n, count(",") / n, math.log1p(len(lines)),
        n / len(lines), len(set(lines)) / len(lines), sum(len(line) < 30 for line in lines) / len(lines),
        (len(text.encode()) - chars) / chars, (sum(map(count, "<>{}[]()")) / n), (count("http") + count("www.")) / n,
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows)] or [pa.array([], pa.float64())] * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *STATISTICS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{s} double" for s in STATISTICS)]))


def tree_rules(description: str) -> list[tuple]:
    """All paths of printed trees as rules: sorted ((statistic, side), bound) pairs.

    Side "<=" or ">"; of several bounds on one side of a statistic the tightest stays.
    """
    found: dict[tuple, None] = {}
    path: list[tuple[int, int, str, float]] = []
    for line in description.splitlines():
        step = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not step:
            if line.lstrip().startswith("Tree"):
                path = []
            continue
        depth = len(step[1])
        while path and path[-1][0] >= depth:
            path.pop()
        path.append((depth, int(step[2]), step[3], float(step[4])))
        bounds: dict[tuple[int, str], float] = {}
        for _, feature, side, bound in path:
            held = bounds.get((feature, side))
            tighter = bound if held is None else (min if side == "<=" else max)(held, bound)
            bounds[feature, side] = tighter
        found[tuple(sorted(bounds.items()))] = None
    return list(found)


def rule_column(rule: tuple) -> Column:
    """A rule as a condition on the statistics' columns."""
    parts = [F.col(STATISTICS[f]) <= bound if side == "<=" else F.col(STATISTICS[f]) > bound
             for (f, side), bound in rule]
    return reduce(Column.__and__, parts)


def train(stats: DataFrame, labels: DataFrame) -> tuple[list[tuple], list[float], float]:
    """Rules, their weights, and the intercept."""
    known = (
        labels.where("doc_id is not null and quality is not null").where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("double")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    )
    rows = stage(stats.join(F.broadcast(known), "doc_id").coalesce(6), "quality-labelled")   # LABELLED rows at most
    counts = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, ones = counts[0], counts[1] or 0.0
    if not 0 < ones < n:
        share = min(max(ones / n if n else 0.0, 1e-9), 1 - 1e-9)
        return [], [], math.log(share / (1 - share))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows).select("x", "label").cache()
    forest = RandomForestClassifier(
        featuresCol="x", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5, seed=17).fit(vectors)
    vectors.unpersist()
    rules = tree_rules(forest.toDebugString)
    if not rules:
        share = ones / n
        return [], [], math.log(share / (1 - share))
    # All distinct rules, at most 2 ** (DEPTH + 1) - 2 of each tree; the lasso alone chooses.
    fires = F.array(*[rule_column(r).cast("double") for r in rules])
    fired = rows.select(array_to_vector(fires).alias("x"), "label").cache()
    lasso = LogisticRegression(featuresCol="x", regParam=LASSO, elasticNetParam=1.0, maxIter=60).fit(fired)
    fired.unpersist()
    kept = [(r, w) for r, w in zip(rules, lasso.coefficients.toArray().tolist()) if w]
    return [r for r, _ in kept], [w for _, w in kept], float(lasso.intercept)


def score_column(rules: list[tuple], weights: list[float], intercept: float) -> Column:
    total = F.lit(intercept)
    for rule, weight in zip(rules, weights):
        total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    stats = stage(measured(docs), "quality-statistics")
    model = train(stats, labels)
    return stats.select("doc_id", held_out().alias("held_out"), score_column(*model).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))
