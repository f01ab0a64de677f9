"""Connected components of a link table.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round is two aggregates and
two joins over the links, the number of rounds grows with the logarithm of the
longest chain, and no component is ever gathered in one place. A round's links
are written to the shared checkpoint folder, so a lost executor repeats one
round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import cut_lineage


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, label) for every node of ``edges`` that has a link to another one;
    label is the smallest node reachable. No links: an empty table."""
    links = cut_lineage(
        edges.where(F.col(u) != F.col(v))
        .select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now[0] == 0 or now == seen:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
            )
        seen = now
        links = cut_lineage(_small_star(_large_star(links)).distinct(), "links")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the smallest neighbour."""
    ways = links.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(
        links.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    )
    least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return ways.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("hi"), F.col("m").alias("lo"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node links to the smallest one."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    inner = links.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return inner.unionByName(least.select("hi", F.col("m").alias("lo")))
