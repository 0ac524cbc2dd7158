"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

from snapbook.llm.shared import cut


def _hang(links: DataFrame, low: DataFrame) -> DataFrame:
    return links.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame) -> Row:
    """Count and hash of a table of links: equal before and after a round that changes nothing."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``links(a, b)`` that has a smaller one.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each round hangs neighbours below the smallest
    one, so the number of rounds grows with the logarithm of the longest chain. Minima combine before the exchange and
    the join on a hub is an ordinary one that can be split. Every round is a table in the shared folder. Links that are stars already take one round.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    )
    seen = _state(edges)
    while True:
        # Large star: neighbours above u move to the smallest neighbour of u.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = cut(_hang(both.filter("v > u"), low).distinct())
        # Small star: u and its smaller neighbours move to the smallest of them.
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = _hang(edges, low).unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(hung.distinct())
        state = _state(edges)
        if state == seen:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
