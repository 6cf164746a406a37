"""Change feeds between two states of a table, told by hashes, and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_hash(columns: list[str], seed: int) -> Column:
    """64 bits of a row's values and of which of them are null, which the hash itself passes over."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def _marks(columns: list[str]) -> list[Column]:
    """Two sums of hashes and a count, which are the same for the same rows in any order."""
    return [F.sum(row_hash(columns, seed).cast("decimal(20,0)")).alias(f"h{seed}_") for seed in (1, 2)] + [F.count("*").alias("n_")]


def feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """op (insert, update, delete), the key and the new values of what ``new`` changes of ``old``.

    Rows are told by ``keys``; a key with several rows counts as the bag of
    them, and all its new rows are in the feed if one of them changed. Deleted
    keys have one row with nulls. A null in a key is a value. Of the old state
    only keys and hashes travel; maps can't be hashed. The new state has the
    old one's columns; other columns are an error.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("both states have the same columns")
    rest = [c for c in new.columns if c not in keys]
    before = old.groupBy(*keys).agg(*_marks(old.columns)).select(*[F.col(c).alias(f"k{i}_") for i, c in enumerate(keys)], "h1_", "h2_", "n_")
    whole = Window.partitionBy(*keys)
    # In the order of the old columns, as hashes depend on it.
    marked = new.select(*old.columns).select("*", row_hash(old.columns, 1).cast("decimal(20,0)").alias("r1_"), row_hash(old.columns, 2).cast("decimal(20,0)").alias("r2_"))
    after = marked.select(*new.columns, F.sum("r1_").over(whole).alias("g1_"), F.sum("r2_").over(whole).alias("g2_"), F.count("*").over(whole).alias("m_"))
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"k{i}_"))
    both = after.join(before, same, "full_outer")
    op = F.when(F.col("n_").isNull(), "insert").when(F.col("m_").isNull(), "delete").when((F.col("h1_") != F.col("g1_")) | (F.col("h2_") != F.col("g2_")) | (F.col("n_") != F.col("m_")), "update")
    key = [F.when(F.col("m_").isNull(), F.col(f"k{i}_")).otherwise(F.col(c)).alias(c) for i, c in enumerate(keys)]
    return both.withColumn("op", op).where("op is not null").select("op", *key, *rest)


def applied(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` after a feed: rows of its keys go, and those that it brings come. Applying it again changes nothing."""
    touched = changes.select(*[F.col(c).alias(f"k{i}_") for i, c in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"k{i}_"))
    return old.join(touched, same, "left_anti").unionByName(changes.where("op <> 'delete'").select(*old.columns))
