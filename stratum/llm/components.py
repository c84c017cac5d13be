"""Connected components of a table of links, by large-star and small-star steps on the whole table.

While there are few links, what is looked up is broadcast: a task of a shuffle takes pages of memory even for a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.scratch import staged


#: Rows that are broadcast at most.
FEW = 50_000


def few(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` to be joined, of which there are ``count``."""
    return F.broadcast(rows) if count <= FEW else rows


def _starred(edges: DataFrame, count: int) -> DataFrame:
    """Links (a, b) with a > b: the neighbours of each node are tied to the smallest one of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = few(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("least")), 2 * count)
    large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    # A node's larger neighbours move to its smallest neighbour; its own link to that one stays.
    own = least.filter(F.col("least") < F.col("a")).select("a", F.col("least").alias("b"))
    tied = large.unionByName(own).filter(F.col("a") > F.col("b"))
    return tied if 2 * count <= FEW else tied.distinct()


def _small(edges: DataFrame, count: int) -> DataFrame:
    least = few(edges.groupBy("a").agg(F.min("b").alias("least")), 2 * count)
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).filter(F.col("a") > F.col("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node of ``links`` (a, b): the smallest node it is connected with."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter(F.col("a") > F.col("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = staged(_small(_starred(edges, state[0]), state[0]), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
