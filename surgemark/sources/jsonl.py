"""Record events as JSON lines and read recordings back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from surgemark.functions.scalar import epoch, from_epoch
from surgemark.sources.arrival import read_lines
from surgemark.schemas import EVENT_JSON

MAX_RECORDS_PER_FILE = 200_000
_REQUIRED = ("ts", "source", "id", "kind", "actor", "subject")


def recordable(events: DataFrame) -> DataFrame:
    return events.select(
        epoch(F.col("ts")).alias("ts"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_JSON.fields if f.name != "ts"],
    )


def record_events(events: DataFrame, path: str, max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Append events; long runs roll over to further files."""
    (
        recordable(events).write.mode("append")
        .option("maxRecordsPerFile", max_records)
        .option("ignoreNullFields", "false")
        .json(path)
    )


def read_recording(spark: SparkSession, path: str) -> DataFrame:
    """Events of a recording, ``seq`` in order of arrival; blank lines, bad JSON, records with a
    field missing that has no default, and records with a field that events do not have are
    skipped."""
    return parse_recorded(read_lines(spark, path).where(F.trim("value") != ""))


def parse_recorded(lines: DataFrame, payload: str = "value") -> DataFrame:
    """Decode one event per row; streaming and batch frames alike."""
    known = F.array(*[F.lit(f.name) for f in EVENT_JSON.fields])
    keys = F.json_object_keys(payload)
    e = F.from_json(F.col(payload), EVENT_JSON)
    complete = F.lit(True)
    for name in _REQUIRED:
        complete = complete & F.col("_e")[name].isNotNull()
    columns = [c for c in lines.columns if c != payload]
    return (
        lines.withColumn("_e", e).withColumn("_keys", keys)
        .where(complete & (F.size(F.array_except("_keys", known)) == 0))
        .select(
            from_epoch(F.col("_e.ts")).alias("ts"),
            *[F.col("_e")[n].alias(n) for n in ("source", "id", "kind", "actor", "subject")],
            F.coalesce(F.col("_e.bot"), F.lit(False)).alias("bot"),
            F.coalesce(F.col("_e.bytes_delta"), F.lit(0).cast("long")).alias("bytes_delta"),
            F.coalesce(F.col("_e.weight"), F.lit(1.0)).alias("weight"),
            F.coalesce(F.col("_e.dims"), F.create_map().cast("map<string,string>")).alias("dims"),
            *columns,
        )
    )
