"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlab.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Columns node, root: every node that has a link, with the smallest node it reaches.

    ``links`` has columns a, b of one orderable type. A large star joins the greater
    neighbours of a node to the smallest one, a small star the smaller ones; in turns they
    end in stars around each root, after a logarithmic number of rounds. Each step keeps
    at most as many links as it was given, and is written before the next reads it. The
    minima are written too: both sides of the join that follows then have shuffles of
    their own, whose hot nodes adaptive execution splits.
    """
    links = stored(_down(links), "links")
    before = None
    while True:
        links = stored(_star(links, large=True), "links")
        links = stored(_star(links, large=False), "links")
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def _down(links: DataFrame) -> DataFrame:
    """Each link once, from the greater node to the smaller."""
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = stored(least.select("a", F.least("a", "m").alias("m")), "link-minima")
    joined = near.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return _down(out)
