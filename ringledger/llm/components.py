"""Connected components of an undirected graph as DataFrame jobs: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored


#: A table of keys with up to so many rows may be broadcast: some tens of megabytes.
BROADCAST_ROWS = 500_000
#: A graph with up to so many edges is worked on in one partition: a few megabytes.
SMALL_GRAPH = 200_000


def merged(side: DataFrame) -> DataFrame:
    """A side of a join that Spark must not broadcast.

    Spark sizes a table by its compressed files and does not see that each of its rows is filed under many keys, so it may send
    hundreds of megabytes through the driver.
    """
    return side.hint("merge")


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join on ``key`` whose sides are both dealt anew, so that Spark can split a hot key.

    A side that an aggregate has already dealt by the key alone could not be split.
    """
    mixed = "_mixed"
    return left.withColumn(mixed, F.xxhash64(key)).join(right.withColumn(mixed, F.xxhash64(key)), [mixed, key], how).drop(mixed)


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join to a stored table: sent to every executor if it has at most ``BROADCAST_ROWS`` rows, else as ``spread_join``."""
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, how)
    return spread_join(left, right, key, how)


def of_pairs(contents: DataFrame, pairs: DataFrame) -> DataFrame:
    """The contents of keys that pairs (a, b) name: all contents if these are too many to be sent to every executor."""
    keys = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys-of-pairs")
    return contents.join(F.broadcast(keys), "key", "left_semi") if keys.count() <= BROADCAST_ROWS else contents


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of the edges (a, b).

    Every round is a few linear jobs over the edges and is written to the shared folder; their number grows with
    the logarithm of the longest chain. A hub's edges are combined before they are shuffled. A graph of at most
    ``SMALL_GRAPH`` edges is kept in one partition, where the same jobs need no shuffle.

    First the least smaller neighbour of a node takes over the node's other ones. Many edges of a node mostly lead to
    the same few, so about an edge a node is left, and what the rounds list grows with the nodes.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct()
    pairs, before = stored(pairs, "edges"), None
    least = stored(pairs.groupBy("hi").agg(F.min("lo").alias("m")), "least-neighbours")
    others = spread_join(pairs, least, "hi").where("lo != m").selectExpr("lo AS hi", "m AS lo").distinct()
    pairs = stored(least.selectExpr("hi", "m AS lo").unionByName(others).distinct(), "thinned-edges")
    small = pairs.count() <= SMALL_GRAPH

    def kept(df: DataFrame, label: str) -> DataFrame:
        out = stored(df.distinct(), label)
        return out.coalesce(1) if small else out

    join = (lambda left, right, key: left.join(right, key)) if small else spread_join
    pairs = pairs.coalesce(1) if small else pairs
    while True:
        # Every larger neighbour of a node is hung below the least of the node and its neighbours.
        both = pairs.selectExpr("inline(array(struct(hi AS u, lo AS v), struct(lo AS u, hi AS v)))")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join(both.where("v > u"), least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = kept(large, "large-star")
        # Every smaller neighbour of a node, and the node, are hung below the least of them.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        star = join(large, least, "hi").selectExpr("inline(array(struct(hi, m AS lo), struct(lo AS hi, m AS lo)))")
        pairs = kept(star.where("hi != lo"), "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.selectExpr("inline(array(struct(hi AS node, lo AS root), struct(lo AS node, lo AS root)))").distinct()
