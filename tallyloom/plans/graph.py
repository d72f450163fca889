"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.scratch import checkpointed

#: A node with more than one in so many of the links is hot; there are fewer such nodes than this.
_HOT = 256
_LEAST_HOT = 1_000


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node) for all nodes
    that have an edge to another node.

    Large-star and small-star steps need a logarithmic number of rounds and
    only ever take minima per node. Each round is checkpointed, so the plan
    does not grow and a lost executor costs one round. Links of a node that
    has very many of them stay where they are: the minima of the few such nodes
    go to them.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    links = checkpointed(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    digest = _digest(links)
    while True:
        starred = checkpointed(_small_star(_large_star(links, digest[0]), digest[0]))
        before, digest = digest, _digest(starred)
        if before == digest:
            break
        links = starred
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _large_star(links: DataFrame, total: int) -> DataFrame:
    """Each link's larger end goes to the least neighbour of its smaller end, or stays where there is none."""
    told = _with_least(links, "v", total)
    return told.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """Each node's smaller neighbours go to the least of them, and so does the node."""
    told = _with_least(links, "u", total)
    both = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return told.select(F.inline(both)).filter("u <> v").distinct()


def _with_least(links: DataFrame, key: str, total: int) -> DataFrame:
    """Links with ``m``, the least neighbour of their ``key`` end among smaller ones, or null."""
    least = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    limit = max(_LEAST_HOT, total // _HOT)
    crowds = links.groupBy(F.col(key).alias("node")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("node")
    hot = F.broadcast(crowds.join(least, "node", "left"))  # about _HOT rows at most
    here = links.join(hot, links[key] == hot["node"]).select("u", "v", "m")
    rest = links.join(hot, links[key] == hot["node"], "left_anti")
    return here.unionByName(rest.join(least, rest[key] == least["node"], "left").select("u", "v", "m"))


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
