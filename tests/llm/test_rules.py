import brute
import pytest
from pyspark.sql import functions as F

from surgemark.llm import quality_rules as qr


def rows_of(spark, make_docs, docs):
    return qr.rule_report(make_docs(docs)).collect()


def test_measures_equal_brute_force(spark, make_docs, odd):
    docs = [*odd, (None, "x"), odd[6], (99, "a b c\na b c\n \n\na b c d"), (100, "w " * 49 + "w"), (101, "#|$ <a> " * 70)]
    got = sorted(((r.doc_id, *(r[m] for m in qr.MEASURES[:5]), r.base_failed) for r in rows_of(spark, make_docs, docs)), key=repr)
    want = [(d, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for d, t in docs for m in [brute.rules(t)]]
    assert got == sorted(want, key=repr)
    assert rows_of(spark, make_docs, []) == []


def test_repeats_are_compared_by_text_not_by_hash(spark, monkeypatch, make_docs):
    """With a hash that is the same for all windows, only equal windows count."""
    monkeypatch.setattr(qr.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    text = "a b c d e a b c x y z"
    assert rows_of(spark, make_docs, [(1, text)])[0].n_repeat_words == brute.rules(text)[4] == 6


def test_policies_are_masks_over_one_ledger(spark, make_docs):
    prose = " ".join(f"word{i}" for i in range(80))
    docs = [(1, prose), (2, prose + " $" * 30), (3, "short"), (4, prose.upper()), (5, (prose + "\n") * 3)]
    rows = qr.ledger(make_docs(docs)).persist()
    verdict = {v: {r.doc_id for r in qr.apply_policy(rows, p).where("kept").collect()} for v, p in qr.POLICIES.items()}
    assert verdict == {"1": {1, 2, 4}, "2": {1, 4}, "3": {1}}
    for v, p in qr.POLICIES.items():
        for row in qr.ablations(rows, {v: p}).collect():
            rest = [r for r in p if r != row.rule]
            failed = {r.doc_id for r in rows.where(qr.fails([row.rule])).collect()}
            kept, without = (len(qr.apply_policy(rows, x).where("kept").collect()) for x in (p, rest))
            assert (row.failed, row.failed_alone, row.kept, row.kept_without) == (len(failed), without - kept, kept, without)


def test_no_python_and_no_shuffle_in_the_plan(spark, make_docs):
    plan = qr.rule_report(make_docs([(1, "a")])).select("kept")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "Exchange" not in qr.rule_report(docs)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_clean_documents_stay_and_junk_goes(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = qr.rule_report(docs).join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    clean, junk = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert all(clean) and not any(junk)
