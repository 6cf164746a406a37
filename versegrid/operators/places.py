"""Places in a global order without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import cut


def numbered(rows: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """``rows`` with their place, from 1, in an order of values; equal rows take places beside each other.

    Rows are dealt by ranges of the order and numbered in each; what a range
    starts with comes from the counts of those before, one row a range. The
    ranges are stored first, as another run of the plan could cut them
    elsewhere.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(dealt.select("*", F.spark_partition_id().alias("range_"), F.monotonically_increasing_id().alias("at_")))
    sizes = ranged.groupBy("range_").agg(F.count("*").alias("n_"), F.min("at_").alias("first_"))
    # Ranges are as many as shuffle partitions at most, whatever the rows.
    starts = sizes.select("range_", "first_", (F.sum("n_").over(Window.orderBy("range_")) - F.col("n_")).alias("before_"))
    place = (F.col("before_") + F.col("at_") - F.col("first_") + 1).cast("bigint").alias(name)
    return ranged.join(F.broadcast(starts), "range_").select(place, *rows.columns)
