import json

import pytest
from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.functions.scalar import epoch
from surgemark.operators import ingest
from surgemark.sources import capture, jsonl, recentchange, registry
from tests.conftest import make_events


def normalise(spark, *payloads):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    raw = spark.createDataFrame(rows, "seq long, value string")
    out = recentchange.normalise_recentchange(raw, ingest_time=F.lit(99.5), seq=F.col("seq"))
    return {r.seq: r for r in out.withColumn("t", epoch(F.col("ts"))).collect()}


def test_recentchange_fields(spark):
    r = normalise(spark, {
        "meta": {"id": "m", "domain": "d.x.org"}, "server_name": "en.wikipedia.org", "type": "new",
        "user": "U", "title": "T", "bot": True, "timestamp": 1700000000, "namespace": 0,
        "length": {"old": 10, "new": 4}})[0]
    assert (r.id, r.kind, r.actor, r.subject, r.bot, r.bytes_delta, r.weight, r.t) == (
        "m", "new", "U", "T", True, -6, 6.0, 1700000000.0)
    assert r.dims == {"domain": "en.wikipedia.org", "lang": "en", "kind": "new", "namespace": "0",
                      "user_type": "bot"}


def test_recentchange_edges(spark):
    r = normalise(
        spark, {}, {"meta": None, "namespace": None, "user": "", "bot": 0},
        {"meta": {"domain": "de.w.org"}, "length": {"old": None, "new": 25.9}, "timestamp": "12.5"},
        {"length": {"new": "7"}, "timestamp": "soon", "bot": "false"}, {"id": 5, "server_name": ""},
        "[1]", "oops", "5", "null", '"text"', "")
    assert sorted(r) == [0, 1, 2, 3, 4]
    assert r[0].dims["namespace"] == "?" and r[0].id == "?-99.5" and r[0].kind == "edit"
    assert r[1].dims["namespace"] == "None" and r[1].actor == "?" and not r[1].bot
    assert r[2].bytes_delta == 25 and r[2].dims["lang"] == "de" and r[2].id == "de.w.org-12.5"
    assert r[3].bytes_delta == 0 and r[3].t == 99.5 and r[3].bot
    assert r[4].id == "5" and r[4].dims["domain"] == "?"


def test_recentchange_times(spark):
    """Any number a timestamp can hold is kept, milliseconds by mistake included."""
    times = ["1.7e12", "1e13", '"NaN"', "-5"]
    raw = spark.createDataFrame([(f'{{"timestamp": {t}}}', i) for i, t in enumerate(times)], "value string, seq long")
    out = recentchange.normalise_recentchange(raw, ingest_time=F.lit(99.5), seq=F.col("seq"))
    assert [r.us for r in out.orderBy("seq").select(F.unix_micros("ts").alias("us")).collect()] == [
        1_700_000_000_000_000_000, 99_500_000, 99_500_000, -5_000_000]


def test_recentchange_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}", 1)], "value string, seq long")
    out = recentchange.normalise_recentchange(raw, ingest_time=F.lit(1.0), seq=F.col("seq"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1


CAPTURE = (": hi\n\nid: 1\ndata: {\"a\":1}\ndata:  x\n\nevent: m\n\ndata:y\nid\n\nid: 7\r\n\r\n"
           "retry: 5\ndata: z\n\n\ndata: k\n\ndata: lost\n")


@pytest.mark.parametrize("split", ["128m", "13"])
def test_capture_frames(spark, tmp_path, split):
    (tmp_path / "a.sse").write_text(CAPTURE)
    (tmp_path / "b.sse").write_text("data: other\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = capture.read_capture(spark, str(tmp_path)).orderBy("file", "frame").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert [(r.event_id, r.data) for r in rows] == [
        ("1", '{"a":1}\n x'), ("", "y"), ("7", "z"), ("7", "k"), (None, "other")]


def test_recording_round_trip_and_strictness(spark, tmp_path):
    ev = make_events(spark, [{"t": 1.25, "dims": {"lang": "en"}}, {"t": 2, "bot": True}])
    jsonl.record_events(ev, str(tmp_path / "r"))
    jsonl.record_events(ev.limit(0), str(tmp_path / "r"))
    good = {"ts": 3.0, "source": "s", "id": "1", "kind": "k", "actor": "a", "subject": "s"}
    (tmp_path / "r" / "extra.json").write_text("\n".join([
        "", "  ", "nope", json.dumps(good), json.dumps({**good, "surprise": 1}), json.dumps({"ts": 1.0})]))
    back = jsonl.read_recording(spark, str(tmp_path / "r")).withColumn("t", epoch(F.col("ts"))).collect()
    assert sorted(r.t for r in back) == [1.25, 2.0, 3.0]
    filled = next(r for r in back if r.t == 3.0)
    assert (filled.bot, filled.bytes_delta, filled.weight, filled.dims) == (False, 0, 1.0, {})


def test_registry(spark, tmp_path):
    with pytest.raises(ValueError, match="known"):
        registry.get_source("nothing")
    (tmp_path / "x.txt").write_text('{"title":"T"}\nbad\n')
    assert registry.read_events(spark, "recentchange", str(tmp_path / "x.txt")).first().subject == "T"
    (tmp_path / "c.sse").write_text('data: {"title":"C"}\n\n')
    assert registry.read_events(spark, "capture", str(tmp_path / "c.sse")).first().subject == "C"


def test_rate_cap_and_drops(spark):
    ev = make_events(spark, [{"t": 5.0}] * 7 + [{"t": 6.0}] * 2)
    cfg = EngineConfig(max_events_per_sec=3)
    assert sorted(r.seq for r in ingest.rate_cap(ev, cfg).collect()) == [0, 1, 2, 7, 8]
    assert [(r.second, r.dropped) for r in ingest.rate_drops(ev, cfg).collect()] == [(5, 4)]
    assert ingest.rate_cap(ev, EngineConfig()).count() == 9
    assert ingest.rate_drops(ev, EngineConfig()).count() == 0


def test_retime_and_gaps(spark):
    ev = make_events(spark, [{"t": t} for t in (100, 102, 101, 131)])
    moved = ingest.retime(ev, 1000.0, speed=2.0).withColumn("t", epoch(F.col("ts")))
    assert [r.t for r in moved.orderBy("seq").collect()] == [1000.0, 1001.0, 1000.5, 1015.5]
    for chunk in (1, 2, 100):
        gaps = ingest.replay_gaps(ev, 2.0, chunk_rows=chunk).orderBy("seq").collect()
        assert [r.gap for r in gaps] == [0.0, 1.0, 0.0, 5.0]
    assert {r.gap for r in ingest.replay_gaps(ev, 0).collect()} == {0.0}


def test_dedupe(spark):
    ev = make_events(spark, [{"t": 1}])
    assert ingest.dedupe(ev.union(ev)).count() == 1


def test_dedupe_keeps_the_first_to_arrive(spark):
    ev = make_events(spark, [{"t": 1}]).drop("seq", "subject").crossJoin(
        spark.createDataFrame([(4, "late"), (2, "first"), (9, "last")], "seq long, subject string"))
    got = ingest.dedupe(ev)
    assert got.columns == ev.columns
    assert [(r.seq, r.subject) for r in got.collect()] == [(2, "first")]
