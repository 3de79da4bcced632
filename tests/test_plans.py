"""Plan shapes that have to hold at scale."""

import re

import pytest

from checks import queries as q
from checks.oracle import ORACLE
from surgemark.config import EngineConfig
from surgemark.operators import ingest, text
from surgemark.operators import windows as win
from surgemark.plans.detection import score_windows
from surgemark.sources import tables
from tests.conftest import make_windows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def read_schemas(text_plan):
    return re.findall(r"ReadSchema: (.*)", text_plan)


@pytest.fixture(scope="module")
def ev(spark):
    return tables.normalise_events(spark.read.parquet(f"{SF}/events.parquet"))


def test_scans_read_only_needed_columns(ev):
    text_plan = plan(win.window_metrics(ev, EngineConfig()))
    assert all("props" in s or "event_id" not in s for s in read_schemas(text_plan))
    times = plan(win.series_bounds(win.place_events(ev, EngineConfig()), EngineConfig()))
    assert read_schemas(times) == ["struct<ts:timestamp_ntz>"]


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").where("event_type = 'error'")
    assert "EqualTo(event_type,error)" in plan(win.window_metrics(tables.normalise_events(df), EngineConfig()))


def test_counts_combine_before_the_shuffle(ev):
    text_plan = plan(win.window_metrics(ev, EngineConfig()))
    assert "partial_count" in text_plan and "SinglePartition" not in text_plan


def test_fold_late_orders_raw_events_inside_chunks_only(ev):
    text_plan = plan(win.fold_late(win.place_events(ev, EngineConfig())))
    specs = re.findall(r"windowspecdefinition\(([^)]*?) (?:ASC|DESC)", text_plan)
    raw = [s for s in specs if "seq" in s]
    assert raw and all("_chunk" in s for s in raw)
    # With one global series the chunk extremes, and nothing else, meet in one place.
    single = re.findall(r"Input \[\d+\]: \[(.*)\]\nArguments: SinglePartition", text_plan)
    assert all("_chunk" in s and "head_" in s and "seq" not in s for s in single)


def test_detectors_sequence_slices_not_series(spark):
    cfg = EngineConfig(detectors=("zscore", "ewma"))
    text_plan = plan(score_windows(make_windows(spark, range(50)), cfg))
    specs = re.findall(r"windowspecdefinition\(([^)]*?) (?:ASC|DESC)", text_plan)
    assert specs and all("slice" in s for s in specs)
    shuffles = re.findall(r"hashpartitioning\(series#\d+, slice#\d+L", text_plan)
    # One exchange of window rows feeds gap filling and both detectors.
    assert len(set(shuffles)) == 1 and "SinglePartition" not in text_plan


def test_topk_is_cut_before_the_shuffle(ev):
    cfg = EngineConfig()
    assert plan(win.dim_topk(win.dim_counts(ev, cfg), cfg)).count("WindowGroupLimit") >= 2
    capped = ingest.rate_cap(ev, EngineConfig(max_events_per_sec=5))
    assert plan(capped).count("WindowGroupLimit") >= 2


def test_bm25_ranks_with_a_group_limit_and_no_product(spark):
    docs = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "alpha")], "query_id long, text string")
    text_plan = plan(text.bm25(docs, asked, 3, staged=False))
    assert "WindowGroupLimit" in text_plan and "CartesianProduct" not in text_plan


def test_bm25_keeps_tokens_off_the_network(spark, tmp_path):
    """The small vocabulary is sent to the documents; postings are combined, then exchanged."""
    from surgemark.plans import staging

    stored = []
    spark.createDataFrame([(i, f"alpha word{i} beta") for i in range(50)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    asked = spark.createDataFrame([(1, "alpha word3")], "query_id long, text string")
    keep = text.stage
    try:
        text.stage = lambda df, name: (stored.append((name, plan(df))), staging.stage(df, name))[1]
        out = text.bm25(docs, asked, 3).collect()
    finally:
        text.stage = keep
    assert out[0].doc_id == 3
    (_, _), (name, postings) = stored
    assert name == "postings" and "BroadcastHashJoin LeftSemi" in postings
    exchanged = re.findall(r"Arguments: hashpartitioning\(term#\w+, doc_id#\w+, len#\w+", postings)
    assert len(exchanged) == postings.count("hashpartitioning") == 1 and "partial_count" in postings


def test_retention_prunes_days(spark, tmp_path):
    from surgemark.operators import history

    rows = spark.range(40).selectExpr("timestamp_seconds(86400 * id) as time", "id as n")
    history.append_by_day(rows, f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m")
    kept = history.retain(stored, EngineConfig())
    filters = re.findall(r"PartitionFilters: (.*)", plan(kept))
    assert any("day" in f for f in filters)
    assert sorted(r.n for r in kept.collect()) == list(range(32, 40))


def test_every_query_has_sql(spark):
    assert set(q.QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert "top_value" in df.columns and df.count() > 0
