"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surgemark.plans.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(u, v) for each linked node u but the smallest v of its component.

    ``links`` has two long columns a, b. In a large star every node hands its larger
    neighbours to its smallest one, in a small star its smaller ones; repeated in turn they
    leave one star for each component after a number of rounds that grows with the
    logarithm of its size. Each round is a grouped minimum and a join, so no component is
    ever gathered, and is written to the shared folder.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stage(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    return edges


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
