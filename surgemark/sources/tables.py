"""Adapters from warehouse tables to the canonical event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surgemark.functions.scalar import blank_to_null

EVENT_COLUMNS = ("ts", "source", "id", "kind", "actor", "subject", "bot", "bytes_delta",
                 "weight", "dims", "seq")


def dims_map(**values: Column) -> Column:
    pairs = []
    for name, col in values.items():
        pairs += [F.lit(name), col]
    return F.create_map(*pairs)


def lang_of(domain: Column) -> Column:
    return F.coalesce(blank_to_null(F.split_part(domain, F.lit("."), F.lit(1))), F.lit("?"))


def normalise_events(raw: DataFrame) -> DataFrame:
    """The ``events`` table (event_id, ts, user_id, event_type, value, props)."""
    k = F.get_json_object("props", "$.k").cast("long")
    kind = (
        F.when(F.col("event_type") == "signup", "new")
        .when(F.col("event_type") == "purchase", "log")
        .when(F.col("event_type") == "error", "categorize")
        .otherwise("edit")
    )
    size = F.floor("value").cast("long")
    bot = F.col("user_id") % 5 == 0
    site = F.concat(F.lit("k"), (k % 10).cast("string"))
    typed = raw.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("events").alias("source"),
        F.col("event_id").cast("string").alias("id"),
        kind.alias("kind"),
        F.col("user_id").cast("string").alias("actor"),
        k.cast("string").alias("subject"),
        bot.alias("bot"),
        F.when(F.col("event_type") == "error", -size).otherwise(size).alias("bytes_delta"),
        F.concat(site, F.lit(".example.org")).alias("_domain"),
        site.alias("_lang"),
        (k % 4).cast("string").alias("_ns"),
        F.col("event_id").alias("seq"),
        "event_type",
    )
    return typed.select(
        *[c for c in EVENT_COLUMNS if c not in ("weight", "dims", "seq")],
        F.abs("bytes_delta").cast("double").alias("weight"),
        dims_map(
            domain=F.col("_domain"), lang=F.col("_lang"), kind=F.col("kind"),
            namespace=F.col("_ns"),
            user_type=F.when(F.col("bot"), "bot").otherwise("human"),
        ).alias("dims"),
        "seq", "event_type",
    )


def normalise_orders(raw: DataFrame) -> DataFrame:
    """The ``orders`` table as a second event source (dates repeat, order key is arrival)."""
    size = F.floor("o_totalprice").cast("long")
    return raw.select(
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.lit("orders").alias("source"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("kind"),
        F.col("o_custkey").cast("string").alias("actor"),
        F.col("o_orderkey").cast("string").alias("subject"),
        F.lit(False).alias("bot"),
        size.alias("bytes_delta"),
        F.abs(size).cast("double").alias("weight"),
        dims_map(domain=F.col("o_orderpriority"), kind=F.col("o_orderstatus")).alias("dims"),
        F.col("o_orderkey").alias("seq"),
    )
