"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsgrain.llm.common import in_few_files, stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def stars(links: DataFrame) -> DataFrame:
    """``(a, b)``: every linked node but its component's smallest, and that one.

    ``links(a bigint, b bigint)`` may repeat links, in either direction.  Each
    round points nodes at the smallest neighbour of a neighbour (large star),
    then gathers the smaller neighbours (small star).  A node's neighbours are
    reduced by map-side minima and joined back, never gathered in one place;
    each round is a stored table.  Rounds grow with the logarithm of the
    longest chain."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(in_few_files(large, state[0]), "large-stars")  # no round makes more links than it has
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(in_few_files(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), state[0]), "stars")
        before, state = state, _state(edges)
        if state == before:
            return edges
    return edges
