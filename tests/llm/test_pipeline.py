import brute
import pytest

import corpus_pipeline
from surgemark.llm import registry, toxicity
from surgemark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in registry.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_stages_do_what_they_say(spark):
    from surgemark.plans.staging import stage

    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, work in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(work(spark, docs, SF), f"test-{name}")
        if name != "best_fit_packing":
            assert docs.columns == columns
        kept[name] = before, docs.collect()
    before, after = kept["exact_dedup"]
    assert {r.doc_id for r in after} == {v[0] for v in brute.exact_groups(before).values()}
    before, after = kept["simhash_near_dedup"]
    assert {r.doc_id for r in after} == set(brute.components({d: brute.simhash(t) for d, t in before}).values())
    before, after = kept["suffix_array_dedup"]
    assert {r.doc_id: r.text for r in after} == brute.passages(before, corpus_pipeline.PASSAGE)
    before, after = kept["best_fit_packing"]
    assert {r.doc_id for r in after} == {d for d, _ in before}
    before, after = kept["toxicity"]
    toxic = {r.doc_id for r in table(spark, SF, "labels").where("toxic = 1").collect()}
    gone = {d for d, _ in before} - {r.doc_id for r in after}
    rated = toxicity.toxicity(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert gone == {r.doc_id for r in rated if r.predicted} and len(gone & toxic) > len(toxic) / 2


def test_stages_on_odd_rows(spark, make_docs, odd, tmp_path):
    labels = spark.createDataFrame([(d, 1, i % 2) for i, (d, _) in enumerate(odd[:9])], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (make_docs([*odd, (None, "no id"), odd[6]]), make_docs([])):
        for _, work in corpus_pipeline.STAGES:
            work(spark, docs, str(tmp_path)).count()
