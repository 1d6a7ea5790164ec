"""Connected components of links that are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userlake.llm.common import by_merge, stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour or itself."""
    around = _both_ways(links)
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    return around.join(by_merge(least), "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.least("u", "m").alias("v")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(by_merge(least), "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node, the component being its smallest node.

    Large and small stars alternate until nothing changes; each round's links
    are written to the shared folder. Two numbers of a round reach the driver.
    Links of a node to itself are ignored; no links give no rows.
    """
    links = stored(links.select("u", "v").where("u <> v").distinct(), "links")
    state = _state(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
