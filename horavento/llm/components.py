"""Connected components of a link table, as DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from horavento.session import materialize


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step of the alternating algorithm.

    Every step is a minimum per node (partial aggregate) joined back to the
    links (an inner join, whose hot nodes adaptive execution can split)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(low, "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    return (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected links ``(u, v)``;
    ``component`` is the smallest node reachable.

    Distributed union-find by alternating large-star and small-star steps,
    until a round changes nothing (two aggregates of the written round tell).
    Each round is written to the shared checkpoint folder, which cuts the
    lineage and survives lost executors.  Links from a node to itself and
    links with a null end are ignored; no link, no row."""
    links = (edges.select("u", "v").where("u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links, before = materialize(links, name), None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        links = materialize(_round(links), name)
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
