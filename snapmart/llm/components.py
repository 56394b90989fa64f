"""Connected components by alternating stars.

Each round hangs the larger neighbours of a node, then the smaller ones, on the
least node known; the rounds end with one star a component. The least neighbour
is an aggregate, reduced in each task first, and joined back to the links. The
links of one node meet in one task of that join unless adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import staged
from snapmart.sources.staging import discard


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): root is the least node of the component.

    Nodes without a link to another node do not appear. Links may repeat, run
    either way or join a node to itself; links with a null end are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.where("u != v").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The least neighbour of a node is its new parent; the other ones hang on it too.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, staged(moved.unionByName(small.withColumnRenamed("m", "v")).distinct(), "stars")
        discard(last)
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame):
    """Changes with the set of edges; the sum is taken in 38 digits, which no count of hashes fills."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
