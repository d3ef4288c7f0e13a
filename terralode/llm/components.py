"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from terralode.llm.common import saved


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component`` of every id in a link ``a, b``: the smallest id it reaches.

    Alternates two steps: each id links its larger neighbours to its smallest one,
    then its smaller ones to the smallest of them. The links end as stars around the
    smallest ids after a number of rounds that grows with the logarithm of their
    number. Smallest neighbours are combined before the shuffle, so a hub is no hot
    group; each round's links are written to the shared folder.
    """
    links = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(links)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        near = both_ways(links)
        lowest = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = near.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("b", "low").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = saved(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        now = state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
