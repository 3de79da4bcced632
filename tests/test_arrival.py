import os

from pyspark.sql import functions as F

from surgemark.config import EngineConfig
from surgemark.operators import windows as win
from surgemark.sources import arrival, jsonl
from surgemark.streaming import closing, run
from tests.conftest import make_events


def put(folder, name, data, time):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    os.utime(path, (time, time))


def test_lines_in_order_of_arrival(spark, tmp_path):
    """Files by time, parts of a job together; every split size gives the same rows."""
    job = "0a1b2c3d-0000-1111-2222-333344445555"
    put(tmp_path, "z.log", b"first\r\n\nthird", 10)
    put(tmp_path, f"part-00001-{job}-c000.json", b"p1\n", 20)
    put(tmp_path, f"part-00000-{job}-c001.json", b"p0b\n", 40)
    put(tmp_path, f"part-00000-{job}-c000.json", b"p0a\n" + "é".encode() * 40 + b"\n\xff\n", 30)
    put(tmp_path, "sub/a.log", b"", 50)
    put(tmp_path, "a.log", b"last\n", 60)
    put(tmp_path, "_hidden/x.log", b"no\n", 1)
    want = ["first", "", "third", "p0a", "é" * 40, "�", "p0b", "p1", "last"]
    seen = set()
    for split in (1, 7, 64, 1 << 20):
        rows = arrival.read_lines(spark, str(tmp_path), splitBytes=split).orderBy("seq").collect()
        assert [r.value for r in rows] == want
        seen.add(tuple(r.seq for r in rows))
    assert len(seen) == 1


def test_long_lines_and_packed_files(spark, tmp_path, monkeypatch):
    import gzip

    put(tmp_path, "a.log", b"x" * 100 + b"\n" + b"y" * 300 + b"\nz", 1)
    put(tmp_path, "b.log.gz", gzip.compress(b"packed\nlines\n" + b"0" * 5000), 2)
    put(tmp_path, "c.log", b"end", 3)
    rows = arrival.read_lines(spark, str(tmp_path), splitBytes=40).orderBy("seq").collect()
    assert [len(r.value) for r in rows] == [100, 300, 1, 6, 5, 5000, 3]
    reader = arrival.Arrivals({"path": str(tmp_path), "splitbytes": "40"})
    monkeypatch.setattr(arrival, "CHUNK_BYTES", 16)
    found = [v for s in reader.splits(reader.waiting()) for b in reader.read(s) for v in b.column(1).to_pylist()]
    assert found == [r.value for r in rows]


def test_empty_folder_and_one_file(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert arrival.read_lines(spark, str(tmp_path / "none")).count() == 0
    put(tmp_path, "one.log", b"a\nb\n", 1)
    assert arrival.read_lines(spark, str(tmp_path / "one.log")).count() == 2


def test_a_restarted_stream_goes_on_where_it_was(spark, tmp_path):
    """A late file with an early time comes after what was admitted, in streams and batches."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")

    def go():
        q = arrival.stream_lines(spark, src).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None

    put(tmp_path, "in/b.log", b"b1\nb2\n", 20)
    go()
    go()
    put(tmp_path, "in/a.log", b"a1\n", 10)
    put(tmp_path, "in/c.log", b"c1\n", 30)
    go()
    rows = spark.read.schema("seq long, value string").parquet(out).orderBy("seq").collect()
    assert [r.value for r in rows] == ["b1", "b2", "a1", "c1"]
    assert arrival.read_lines(spark, src).orderBy("seq").collect() == rows


def test_fold_of_a_recording_without_late_events_is_event_time(spark, tmp_path):
    """1,000 events over 30 windows, recorded in time order in several appends."""
    cfg = EngineConfig(tick_seconds=86_400)
    ev = make_events(spark, [{"t": 2_592 * i, "seq": i} for i in range(1000)])
    src = str(tmp_path / "in")
    for lo in (0, 400, 900):
        jsonl.record_events(ev.where(F.col("seq").between(lo, (400, 900, 1000)[(lo > 0) + (lo > 400)] - 1)).orderBy("seq"), src)
        q = closing.fold_stream(run.read_recorded_stream(spark, src, splitBytes=3_000), str(tmp_path / "w"),
                                str(tmp_path / "ck"), cfg)
        q.awaitTermination()
    closing.flush_open(spark, str(tmp_path / "w"), q.lastProgress["batchId"], cfg)
    closed = spark.read.option("recursiveFileLookup", "true").schema(closing.CLOSED_SCHEMA).parquet(str(tmp_path / "w/closed"))
    got = {r.window_id: r["count"] for r in closed.collect()}
    assert got == {r.window_id: r["count"] for r in win.window_metrics(ev, cfg).collect()} and len(got) == 30
    # A batch read folds in the same order.
    folded = win.window_metrics(jsonl.read_recording(spark, src), cfg.with_(late="fold"))
    assert {r.window_id: r["count"] for r in folded.collect()} == got


def test_small_files_share_a_task(spark, tmp_path):
    """Three hundred files in splits of five bytes: a few tasks, and the same lines in the same order."""
    for i in range(300):
        put(tmp_path, f"{i:03}.log", b"abc%03d\nx\n" % i, i + 1)
    rows = arrival.read_lines(spark, str(tmp_path), splitBytes=5)
    assert rows.rdd.getNumPartitions() <= 2
    want = [v for i in range(300) for v in (f"abc{i:03}", "x")]
    assert [r.value for r in rows.orderBy("seq").collect()] == want
    cut = arrival.read_lines(spark, str(tmp_path), splitBytes=5, taskBytes=40_000)
    assert 100 < cut.rdd.getNumPartitions() < 1000
    assert [r.value for r in cut.orderBy("seq").collect()] == want


def test_a_batch_is_read_once_however_much_follows(spark, tmp_path):
    cfg = EngineConfig(tick_seconds=10)
    seen = spark.sparkContext.accumulator(0)

    def passed(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    ev = make_events(spark, [{"t": i, "seq": i, "dims": {"lang": "x"}} for i in range(100)]).coalesce(1)
    closing.fold_batch(ev.mapInPandas(passed, ev.schema), 0, str(tmp_path), cfg)
    closed = spark.read.parquet(str(tmp_path / "closed"))
    assert sorted((r.window_id, r["count"]) for r in closed.collect()) == [(w, 10) for w in range(9)]
    assert seen.value <= 200
