import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgemark.llm import licenses, quality, toxicity
from surgemark.llm.common import held_out

SF = "/root/testdata/sf0.1"


def best_segments(scores):
    """All maximal scoring segments by their recursive definition: the best, then both sides."""
    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                s = sum(scores[a:b])
                if s > 0 and (found is None or s > found[0] + 1e-9 or abs(s - found[0]) < 1e-9 and b - a < found[2] - found[1]):
                    found = (s, a, b)
        return found

    def go(lo, hi):
        found = best(lo, hi)
        return [] if found is None else [*go(lo, found[1]), found, *go(found[2], hi)]

    return go(0, len(scores))


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.uniform(-1.2, 1) for _ in range(rng.randint(0, 14))]
        mine = toxicity.segments(np.array(scores))
        want = best_segments(scores)
        assert [(a, b) for _, a, b in mine] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, _, _ in mine], [s for s, _, _ in want])


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    right = np.mean([r["predicted"] == r[label] for r in rows])
    ones = np.array([r["score"] for r in rows if r[label] == 1])
    zeros = np.array([r["score"] for r in rows if r[label] == 0])
    return right, np.mean(ones[:, None] > zeros[None, :])


@pytest.mark.parametrize("work, label", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_accuracy(spark, work, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = work(docs, labels).cache()
    assert out.count() == docs.count()
    assert out.where("score < 0 or score > 1 or score is null or predicted is null").count() == 0
    right, auc = accuracy(out, labels, label)
    out.unpersist()
    assert right > 0.97 and auc > 0.93


@pytest.mark.parametrize("work, label", [(quality.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_held_out_labels_are_never_read(spark, work, label):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn(label, F.when(held_out(), 1 - F.col(label)).otherwise(F.col(label)))
    a, b = ({r.doc_id: round(r.score, 6) for r in work(docs, x).collect()} for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("work", [quality.quality, toxicity.toxicity])
def test_odd_rows_and_labels(spark, make_docs, odd, work):
    schema = "doc_id long, quality int, toxic int"
    docs = make_docs([*odd, (odd[6][0], odd[6][1]), (None, "no id")])
    none = work(docs, spark.createDataFrame([], schema))
    assert none.count() == len(odd) + 2 and none.agg(F.max("score")).first()[0] < 0.01
    one_kind = spark.createDataFrame([(d, 1, 1) for d, _ in odd], schema)
    assert work(docs, one_kind).agg(F.min("score")).first()[0] > 0.99
    mixed = spark.createDataFrame(
        [(d, i % 2, i % 2) for i, (d, _) in enumerate(odd)] + [(odd[0][0], None, None), (None, 1, 1), (odd[3][0], 0, 1)], schema)
    assert work(docs, mixed).where("score between 0 and 1").count() == len(odd) + 2
    assert work(make_docs([]), mixed).count() == 0


def test_toxic_passages_are_found():
    scores = {"bad": 4.0, "worse": 5.0}
    model = toxicity.Model(scores, 1.0, 0.0, (1.0,) * 3, (0.0,) * 3, (1.0,) * 3, 0.0)
    text = "fine " * 50 + "bad worse" + " fine" * 50
    (start, end, surprise), = toxicity.passages(text, model)
    assert text[start:end] == "bad worse" and surprise > 3


def test_every_copy_of_a_toxic_passage_is_found():
    scores = {w: 4.0 for w in ("bad", "worse", "worst", "vile")}
    model = toxicity.Model(scores, 1.0, 0.0, (1.0,) * 3, (0.0,) * 3, (1.0,) * 3, 0.0)
    passage, gap = "bad worse worst vile", " fine" * 400 + " "
    twice = f"fine {passage}{gap}{passage} fine"
    assert [twice[a:b] for a, b, _ in toxicity.passages(twice, model)] == [passage] * 2
    late = gap.join(["fine", *scores, passage])
    assert [late[a:b] for a, b, _ in toxicity.passages(late, model)] == [passage]
    once = toxicity.measures(f"fine {passage}{gap} fine", scores, 1.0, 0.0)
    assert toxicity.measures(twice, scores, 1.0, 0.0)[2] > once[2] > 0


def test_tree_rules():
    printed = """RandomForestClassificationModel: uid=x
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     If (feature 0 <= 3.0)
      Predict: 1.0
     Else (feature 0 > 3.0)
      Predict: 0.0
"""
    assert set(quality.tree_rules(printed)) == {
        (((0, "<="), 1.5),), (((0, "<="), 1.5), ((2, "<="), 0.25)), (((0, "<="), 1.5), ((2, ">"), 0.25)),
        (((0, ">"), 1.5),), (((0, "<="), 3.0), ((0, ">"), 1.5)), (((0, ">"), 3.0),)}


def brute_licenses(text):
    words = licenses.WORD.findall(text.lower())
    grams = licenses.shingles(words)
    out = {}
    for name, template in licenses.TEMPLATES.items():
        wanted = set(licenses.shingles(licenses.WORD.findall(template.lower())))
        size = licenses.span(len(wanted))
        best = max((len(set(grams[i:i + size]) & wanted) / len(wanted) for i in range(len(grams))), default=0)
        if best >= licenses.CONTAINED:
            out[name] = best
    return out


def test_license_scan(make_docs, odd):
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice(["the", "license", "under", "work", "is", "of", "x", "y"]) for _ in range(n))
    docs = list(odd)
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        for _ in range(12):
            changed = list(words)
            if rng.random() < 0.5:
                changed[rng.randrange(len(words))] = "zz"
            docs.append((1000 + len(docs), filler(rng.randint(0, 90)) + " " + " ".join(changed).upper() + "\n" + filler(rng.randint(0, 90))))
    docs.append((5000, "\n".join(["Released under the MIT License."] * 4)))
    got = {}
    for r in licenses.license_scan(make_docs([*docs, (None, None)])).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
        assert r.occurrences >= 1 and r.first_word >= 0
        if r.doc_id == 5000:
            assert (r.license, r.occurrences, r.first_word) == ("mit", 4, 0)
    assert got == {d: w for d, t in docs if (w := brute_licenses(t or ""))}
    assert licenses.license_scan(make_docs([])).count() == 0
