"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Intermediates


def _neighbours_minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _neighbours_minimum(both).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the least of them."""
    least = _neighbours_minimum(edges)
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def component_labels(links: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``links (a, b)`` that is not its component's smallest.

    Each round is stored; partial sums of a hash tell when nothing changes any more.  A node
    with many links is one row per task after partial aggregation, and its links are
    joined, which AQE splits."""
    own = Intermediates(links.sparkSession)
    edges = own.store(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            # The last round stays; earlier ones are gone.
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before, last = state, edges
        edges = own.store(_small_star(_large_star(edges)), "links")
        own.drop(last)
