import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("surgemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT_COLUMNS = ["t", "subject", "actor", "kind", "bot", "bytes_delta", "dims", "seq"]


def make_events(spark, rows):
    """rows: dicts with ``t`` (epoch seconds) and any event field."""
    full = []
    for i, r in enumerate(rows):
        full.append((
            float(r["t"]), r.get("subject", "A"), r.get("actor", "u"), r.get("kind", "edit"),
            r.get("bot", False), int(r.get("bytes_delta", 10)), r.get("dims", {}), r.get("seq", i),
        ))
    df = spark.createDataFrame(
        full, "t double, subject string, actor string, kind string, bot boolean, "
              "bytes_delta long, dims map<string,string>, seq long")
    return df.select(
        F.timestamp_micros((F.col("t") * 1e6).cast("long")).alias("ts"), F.lit("test").alias("source"),
        F.concat_ws("-", "subject", "actor", "t", "seq").alias("id"), "kind", "actor", "subject", "bot",
        "bytes_delta", F.abs("bytes_delta").cast("double").alias("weight"), "dims", "seq")


def make_windows(spark, values, start=100, series="all"):
    """Window rows whose count is the given value; tick 1 makes rate equal count."""
    rows = [(series, start + i, int(v), 0, 0, 0, 0, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "series string, window_id long, count long, distinct_subjects long, "
              "distinct_actors long, bot_count long, new_count long, bytes_changed long")
