"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.scratch import written


# A node with more than one in this many of the links is a hub.
HUBS = 64


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links`` with the least node ``m`` around their ``u``, as ``least`` (u, m, links) has it.

    The links of a hub would all meet in one task. There are fewer than ``HUBS`` hubs, whatever the
    graph, so these are broadcast and their links stay where they are; only the rest is shuffled.
    """
    total = least.agg(F.sum("links")).first()[0] or 0
    hub = F.col("links") * HUBS > total
    hubs = least.where(hub).select(F.col("u").alias("hub"), F.col("m").alias("hub_m"))
    found = links.join(F.broadcast(hubs), F.col("u") == F.col("hub"), "left").drop("hub")
    of_hubs = found.where("hub_m IS NOT NULL").withColumnRenamed("hub_m", "m")
    rest = found.where("hub_m IS NULL").drop("hub_m")
    return of_hubs.unionByName(rest.join(least.where(~hub).select("u", "m"), "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(
        F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("links")
    )
    found = _with_least(both.where("v > u"), written(least, "least"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
    least = written(least, "least")
    moved = _with_least(down, least).where("v <> m")
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Columns ``u`` and ``v``: every linked node but the least of its component, and that least.

    ``edges`` has columns ``u`` and ``v`` of one ordered type. Self-links and NULLs are left out, so
    nodes without a link to another are not returned. Every round is written to the shared folder;
    the number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.where("u <> v").select("u", "v")
    state, seen = written(edges, "links"), None
    while True:
        state = written(_small_star(_large_star(state)), "stars")
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first()
        if mark == seen or not mark[0]:
            return state
        seen = mark
