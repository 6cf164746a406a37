"""Native join of places with the intervals that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places that share a bin. An interval is repeated for each bin that it touches; a bin meets few intervals and few places.
WIDTH = 1024


def within(places: DataFrame, intervals: DataFrame, key: str, at: str, low: str = "low_", high: str = "high_", how: str = "inner", width: int = WIDTH) -> DataFrame:
    """``places`` with the columns of the intervals of their key with low <= at <= high.

    The join is by key and bin, so the places and intervals of one key are
    spread over as many groups as it has bins, and no group grows with a key.
    Intervals end at their key's last place at most, or the bins of what lies
    beyond are made for nothing; ``intervals`` has no column of ``places`` but
    the key.
    """
    binned = intervals.withColumn("bin_", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    mine = places.withColumn("bin_", F.floor(F.col(at) / width))
    met = (mine[key] == binned[key]) & (mine["bin_"] == binned["bin_"]) & (F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))
    return mine.join(binned, met, how).select(*[mine[c] for c in places.columns], *[binned[c] for c in intervals.columns if c not in (key, low, high)])
