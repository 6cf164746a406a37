"""Connected components by minimum labels, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, label) of every vertex of ``edges``; label is the component's least vertex.

    Each round takes the least label among a vertex's neighbours and then the
    label of that label, so the rounds grow with the logarithm of the longest
    path. Labels meet by partial minima, hence a vertex with very many
    neighbours costs one row a task; joins leave skew to adaptive execution.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"))
    labels = cut(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("l")).select("v", F.least("v", "l").alias("l")))
    before = None
    while True:
        told = labels.agg(F.sum(F.col("l").cast("decimal(38,0)")).alias("s")).first()["s"]
        if told == before:
            return labels.select("v", F.col("l").alias("label"))
        before = told
        seen = both.join(labels.select(F.col("v").alias("b"), "l"), "b").select(F.col("a").alias("v"), "l")
        least = labels.unionByName(seen).groupBy("v").agg(F.min("l").alias("l"))
        up = labels.select(F.col("v").alias("l"), F.col("l").alias("up"))
        labels = cut(least.join(up, "l", "left").select("v", F.least("l", F.coalesce("up", "l")).alias("l")))
