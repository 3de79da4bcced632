"""Normalise recent-change JSON payloads (one object per row) to canonical events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.functions.scalar import blank_to_null, epoch, from_epoch
from surgemark.sources.tables import dims_map, lang_of

SOURCE = "recentchange"
UNKNOWN = "?"


# The texts of values that count as absent unless they are strings.
FALSY = ("false", "0", "0.0", "-0.0", "[]", "{}")
_NUMBER = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
# Seconds that a timestamp of whole microseconds can hold.
MOST_SECONDS = 9.2e12


def _field(path: str) -> Column:
    return F.try_variant_get("_v", f"$.{path}", "variant")


def _truthy(path: str) -> Column:
    """Text of a value, NULL when it is missing, null, empty, zero or false."""
    value = _field(path)
    text = value.try_cast("string")
    return F.when(text.isin(*FALSY), F.when(F.schema_of_variant(value) == "STRING", text)).otherwise(
        blank_to_null(text))


def _whole(text: Column) -> Column:
    """Number truncated toward zero."""
    return text.try_cast("double").try_cast("bigint")


def _seconds_text(seconds: Column) -> Column:
    """Shortest plain decimal with at least one place: 1700000000.0, 1.25."""
    exact = seconds.cast("decimal(24,6)").cast("string")
    trimmed = F.regexp_replace(exact, "0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def normalise_recentchange(
    raw: DataFrame, payload: str = "value", ingest_time: Column | None = None,
    seq: Column | None = None,
) -> DataFrame:
    """Rows that are not JSON objects are dropped.

    ``ingest_time`` (epoch seconds) stands in for a missing or non-numeric timestamp, and
    for a number of seconds that no timestamp can hold (beyond ``MOST_SECONDS``); passing
    it as a column keeps re-runs identical. Any other number is taken as it is.

    A payload is parsed once: the explode keeps the filter from being moved below it.
    """
    now = epoch(F.current_timestamp()) if ingest_time is None else ingest_time
    stated = _field("timestamp").try_cast("string").try_cast("double")
    stated = F.when(F.isnan(stated) | (F.abs(stated) > MOST_SECONDS), F.lit(None)).otherwise(stated)
    new, old, space = _field("length.new"), _field("length.old").try_cast("string"), _field("namespace")
    delta = F.when(
        F.schema_of_variant(new).rlike(_NUMBER),
        _whole(new.try_cast("string")) - F.coalesce(_whole(old), F.lit(0)),
    ).otherwise(F.lit(0).cast("bigint"))
    space_text = space.try_cast("string")
    namespace = (
        F.when(space.isNull(), F.lit(UNKNOWN))
        .when(F.is_variant_null(space), F.lit("None"))
        .when(
            space_text.isin("true", "false") & (F.schema_of_variant(space) == "BOOLEAN"),
            F.initcap(space_text),
        )
        .otherwise(space_text)
    )
    order = F.monotonically_increasing_id() if seq is None else seq
    objects = (
        raw.select(
            now.alias("_now"), order.alias("seq"), F.explode(F.array(F.try_parse_json(payload))).alias("_v"))
        .where(F.schema_of_variant("_v").startswith("OBJECT"))
    )
    typed = objects.select(
        F.coalesce(_truthy("server_name"), _truthy("meta.domain"), F.lit(UNKNOWN))
        .alias("_domain"),
        F.coalesce(stated, F.col("_now")).alias("_t"),
        F.coalesce(_truthy("meta.id"), _truthy("id")).alias("_id"),
        F.coalesce(_truthy("type"), F.lit("edit")).alias("kind"),
        F.coalesce(_truthy("user"), F.lit(UNKNOWN)).alias("actor"),
        F.coalesce(_truthy("title"), F.lit(UNKNOWN)).alias("subject"),
        _truthy("bot").isNotNull().alias("bot"),
        delta.alias("bytes_delta"),
        namespace.alias("_ns"),
        "seq",
    )
    return typed.select(
        from_epoch(F.col("_t")).alias("ts"),
        F.lit(SOURCE).alias("source"),
        F.coalesce(F.col("_id"), F.concat_ws("-", "_domain", _seconds_text(F.col("_t")))).alias("id"),
        "kind", "actor", "subject", "bot", "bytes_delta",
        F.abs("bytes_delta").cast("double").alias("weight"),
        dims_map(
            domain=F.col("_domain"), lang=lang_of(F.col("_domain")), kind=F.col("kind"),
            namespace=F.col("_ns"), user_type=F.when(F.col("bot"), "bot").otherwise("human"),
        ).alias("dims"),
        "seq",
    )
