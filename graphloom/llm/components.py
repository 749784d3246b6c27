"""Connected components of a graph of links, by alternating large and small stars.

Each half round is an aggregation (a minimum, combined before the shuffle), a join and a distinct;
after about log(n) rounds every node is linked to the least node of its component. Links are written
to the shared folder between rounds; only their count and a checksum come to the driver.

The root of a large component has a link to every member. Minima are therefore written before they
are joined with the links: between plain tables, Spark broadcasts a small side or splits a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _large(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = shared.table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return least, both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("u", "m")).distinct()


def connect(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b; of one type that has an order) but the roots.

    The root is the least node of the component. Links of a node to itself and repeated links change
    nothing; links with a null end are ignored; no links: an empty result.
    """
    links = shared.table(links.toDF("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while True:
        least, further = _large(links)
        after = shared.table(_small(further), "links")
        shared.release(links, least)  # a round's tables are read by the next round only
        links = after
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if state == seen:
            return links.toDF("node", "root")
        seen = state
