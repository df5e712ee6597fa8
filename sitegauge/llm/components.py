"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import staged

MAX_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link: root is the smallest node that can be reached.

    `links`: columns a and b.  Rounds of large stars and small stars: every node hands its larger neighbours, then its
    smaller ones, to the smallest.  Each round is written to the shared folder; only its count and checksum come to the driver.
    Loops, repeated links and either direction are allowed.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row["n"], row["x"]
