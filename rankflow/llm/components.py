"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.operators.joins import join_ranked
from rankflow.sources.workspace import stored


def _least_neighbour(rows: DataFrame) -> DataFrame:
    """``rows`` (u, v) with the smallest ``v`` of each ``u`` as ``least``; a hot ``u`` can be split."""
    least = rows.groupBy("u").agg(F.min("v").alias("least"))
    return join_ranked(rows, least, ["u"], "inner")


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour, or itself, to its larger neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    to = _least_neighbour(both).where("v > u")
    return to.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour to itself and to its other smaller neighbours."""
    to = _least_neighbour(links)
    moved = to.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return moved.where("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row for each linked node: node, root (the smallest node it reaches).

    Links count in both directions, may repeat and may join a node to itself. Nodes are bigint. The
    driver sees a count and a checksum of each round; links stay in tables in the shared folder.
    Without links the result is empty.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links, before = stored(links, "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        links = stored(_small_star(stored(_large_star(links), "stars")), "stars")
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
