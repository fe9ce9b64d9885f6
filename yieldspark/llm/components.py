"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(r)


def stars(edges: DataFrame) -> DataFrame:
    """(a, b) for every node ``a`` that is not the smallest of its component ``b``.

    ``edges``: columns a, b (orderable, not NULL). Each round links every
    larger neighbour of a node to the node's smallest neighbour, then every
    smaller one; no neighbour list is gathered, a hub only meets an aggregate
    and a join whose skewed side Spark splits. Rounds grow with the logarithm
    of the component's size; each ends in a written table.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "edges")
    last = None
    while True:
        now = _signature(e)
        if now == last or now[0] == 0:
            return e
        last = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(large.distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
