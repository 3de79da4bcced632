"""Toxicity by maximum-scoring segments of token log-odds.

Training, on at most ``LABELLED`` labelled documents (those with the smallest hash of their
id, never a held-out one):

* token scores: log-odds of a token's document counts in toxic against other documents, with
  a Dirichlet prior in proportion to the token's count in all of them, ``Z`` standard errors
  nearer to zero. Tokens further than that from zero are kept, any other scores zero;
* every token then costs ``DRIFT``, so that unremarkable text scores below zero;
* the scores' scale (lambda) solves E[exp(lambda * score)] = 1 over all occurrences of tokens
  in other documents, and the location (ln K) of the extreme-value law of their best segments is fitted to them;
* a logistic curve turns three numbers of a document into its score: the calibrated best
  segment, the total of its significant segments, and their number.

Scoring runs over each whole text: one pass finds all maximal scoring segments; those with
an expected number of chance finds of at most ``EXPECTED`` are significant passages.

Odd input: null and empty texts have no segment and get the score of a text without toxic
passages; any length works; rows repeated with one doc_id give one row each; conflicting
labels count as toxic, null labels not at all; without labels of both kinds every score is
the share of toxic labels (0 without any); other columns are ignored or kept unchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from surgemark.llm.common import held_out, text_or_empty
from surgemark.plans.staging import stage

LABELLED = 50_000
Z = 2.0
DRIFT = 0.05
EXPECTED = 0.05
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    scores: dict                  # token -> score, drift not yet taken off
    scale: float                  # lambda
    location: float               # ln K
    weights: tuple                # of the three numbers
    centre: tuple
    spread: tuple
    intercept: float


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, end), left to right, in linear time.

    Every segment found so far keeps the running total before and after it. A new positive
    step looks back for the nearest segment with a lower total before it; if that one also
    ends lower, all from there on become one segment, which looks back in turn.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[float, float, int, int, int]] = []      # before, after, first, end, lower one
    for p in positive.tolist():
        before, after, first = float(total[p]), float(total[p + 1]), p
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= before:
                j = found[j][4]
            if j < 0 or found[j][1] >= after:
                break
            before, first = found[j][0], found[j][2]
            del found[j:]
        found.append((before, after, first, p + 1, j))
    return [(after - before, first, end) for before, after, first, end, _ in found]


def scored(words: list[str], model_scores: dict) -> np.ndarray:
    """Scores of the words in turn; every occurrence of a word counts."""
    return np.array([model_scores.get(w, 0.0) for w in words]) - DRIFT


def measures(text: str, model_scores: dict, scale: float, location: float) -> tuple[float, float, float]:
    """Calibrated best segment, log of the total of significant ones, log of their number."""
    words = tokens(text)
    found = segments(scored(words, model_scores))
    if not found:
        return -20.0, 0.0, 0.0
    # ln of the expected number of chance segments of this score, with its sign changed
    surprise = scale * np.array([s for s, _, _ in found]) - location - math.log(len(words))
    strong = surprise[surprise >= -math.log(EXPECTED)]
    return float(np.clip(surprise.max(), -20, 60)), math.log1p(strong.sum()), math.log1p(len(strong))


def passages(text: str, model: Model) -> list[tuple[int, int, float]]:
    """Significant toxic passages of a text: first and end character, log of the surprise."""
    places = [m.span() for m in WORD.finditer(text)]
    found = segments(scored([text[a:b].lower() for a, b in places], model.scores))
    out = []
    for score, first, end in found:
        surprise = model.scale * score - model.location - math.log(len(places))
        if surprise >= -math.log(EXPECTED):
            out.append((places[first][0], places[end - 1][1], surprise))
    return out


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, text of the documents to learn from."""
    known = (
        labels.where("doc_id is not null and toxic is not null").where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    return rows.join(F.broadcast(known), "id").select("toxic", "text")      # at most LABELLED small rows


def _token_scores(found: DataFrame) -> list:
    """token, score, seen (its occurrences in documents that are not toxic) of the tokens whose odds
    pass ``Z``. They come from at most ``LABELLED`` documents, which bounds their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for token, times in Counter(tokens(text.as_py())).items():
                    of = counts.setdefault(token, [0, 0, 0])
                    of[1 if toxic else 0] += 1
                    of[2] += 0 if toxic else times
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(3))],
                names=["token", "clean", "toxic", "seen"])

    counts = stage(found.mapInArrow(run, "token string, clean long, toxic long, seen long").groupBy("token").agg(
        *(F.sum(c).alias(c) for c in ("clean", "toxic", "seen"))), "token-counts")
    n = counts.agg(F.sum("clean"), F.sum("toxic"), F.count(F.lit(1))).first()
    if not (n[0] and n[1]):
        return []
    # The prior weighs as much as one document for each token of the vocabulary.
    prior = (F.col("clean") + F.col("toxic")) * F.lit(n[2] / (n[0] + n[1]))
    y, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(y / (n[1] + n[2] - y)) - F.log(c / (n[0] + n[2] - c))
    error = F.sqrt(1 / y + 1 / c)
    return (
        counts.where("clean + toxic > 1").select(
            "token", "seen", (F.abs(odds) / error).alias("z"),
            (F.signum(odds) * (F.abs(odds) - Z * error)).alias("score"))
        .where(F.col("z") > Z).select("token", "score", "seen").collect()
    )


def _scale(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1, by halving."""
    weight = weight / weight.sum()

    def over(x: float) -> bool:
        return float((weight * np.exp(np.minimum(x * scores, 700))).sum()) > 1

    low, high = 0.0, 1e-3
    while not over(high) and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if over(mid) else (mid, high)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and intercept by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    found = stage(_labelled(docs, labels), "toxic-labelled")
    rows = _token_scores(found)
    scores = {r["token"]: r["score"] for r in rows}
    share = found.agg(F.avg("toxic")).first()[0] or 0.0
    if not scores:
        bias = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model({}, 1.0, 0.0, (0.0,) * 3, (0.0,) * 3, (1.0,) * 3, bias)
    seen = np.array([r["seen"] for r in rows], float)
    values = np.array([r["score"] for r in rows])
    known = np.concatenate([values, [0.0]]) - DRIFT
    # All other tokens score zero; their number follows from the documents' lengths.
    rest = _clean_tokens(found)
    scale = _scale(known, np.concatenate([seen, [max(rest - seen.sum(), 1.0)]]))

    def measured(location: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = [(*measures(t.as_py(), scores, scale, location), y)
                     for y, t in zip(batch.column(0).to_pylist(), batch.column(1))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*m)], names=["a", "b", "c", "y"])

        rows = found.mapInArrow(run, "a double, b double, c double, y double").collect()
        return np.array([tuple(r) for r in rows]).reshape(-1, 4)

    first = measured(0.0)
    best = first[(first[:, 3] == 0) & (first[:, 0] > -20), 0]
    location = float(best.mean() - np.euler_gamma) if len(best) else 0.0
    m = measured(location)
    centre, spread = m[:, :3].mean(0), m[:, :3].std(0) + 1e-9
    w = _logistic((m[:, :3] - centre) / spread, m[:, 3])
    return Model(scores, scale, location, tuple(w[:3]), tuple(centre), tuple(spread), float(w[3]))


def _clean_tokens(found: DataFrame) -> float:
    """Tokens of all documents that are not toxic, every occurrence counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(len(tokens(t.as_py())) for y, t in zip(batch.column(0).to_pylist(), batch.column(1)) if not y)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return float(found.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0)


def score(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def of(texts):
        m = np.array([measures(t, model.scores, model.scale, model.location) for t in texts]).reshape(-1, 3)
        z = ((m - np.array(model.centre)) / np.array(model.spread)) @ np.array(model.weights) + model.intercept
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return of(text)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    model = train(docs, labels)
    return docs.select("doc_id", held_out().alias("held_out"), score(model, text_or_empty()).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score below one half."""
    return docs.where(score(train(docs, labels), text_or_empty()) < 0.5)
