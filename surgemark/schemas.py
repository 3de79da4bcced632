"""Explicit Spark schemas; nothing in the engine relies on inference."""

from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("bytes_delta", T.LongType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("dims", T.MapType(T.StringType(), T.StringType())),
    T.StructField("seq", T.LongType()),
])

# One recorded JSON line: the event without arrival order, time as epoch seconds.
EVENT_JSON = T.StructType([
    T.StructField("ts", T.DoubleType()),
    *[f for f in EVENT.fields if f.name not in ("ts", "seq")],
])

DETAIL = T.StructType([
    T.StructField("z", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("samples", T.LongType()),
    T.StructField("raw_score", T.DoubleType()),
    T.StructField("warmup", T.BooleanType()),
    T.StructField("unavailable", T.BooleanType()),
])

RESULT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("flag", T.BooleanType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("expected", T.DoubleType()),
    T.StructField("detail", DETAIL),
])

CONTRIBUTION = T.StructType([
    T.StructField("dim", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("observed", T.LongType()),
    T.StructField("baseline", T.DoubleType()),
    T.StructField("excess", T.DoubleType()),
    T.StructField("share", T.DoubleType()),
])

# Stored tables.
METRIC_TABLE = T.StructType([
    T.StructField("time", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("count", T.LongType()),
    T.StructField("distinct_subjects", T.LongType()),
    T.StructField("distinct_actors", T.LongType()),
    T.StructField("bot_ratio", T.DoubleType()),
    T.StructField("bytes_per_sec", T.DoubleType()),
    T.StructField("new_rate", T.DoubleType()),
    T.StructField("detectors", T.ArrayType(RESULT)),
    T.StructField("top", T.MapType(T.StringType(), T.ArrayType(T.StructType([
        T.StructField("value", T.StringType()), T.StructField("cnt", T.LongType())])))),
])

ANOMALY_TABLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("series", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("expected", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("agreement", T.IntegerType()),
    T.StructField("detectors", T.ArrayType(RESULT)),
    T.StructField("why", T.ArrayType(CONTRIBUTION)),
    T.StructField("window_start", T.DoubleType()),
    T.StructField("window_end", T.DoubleType()),
])
