"""All facets and filtered totals of the references in one pass, by grouping sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import or_else

#: The groupings, each under its name; every one is a column or several of the rows.
SETS = {"author": ["author"], "category": ["category"], "work_book": ["id", "book"], "chapter": ["book_slug", "chapter"], "all": []}


def facets(refs: DataFrame, works: DataFrame, categories: list[str]) -> DataFrame:
    """facet, author, category, id, book, book_slug, chapter, n, n_chosen, works, first_slug, first_chapter.

    One row a value of each facet: ``author`` and ``category`` (null or empty:
    Unknown, Other), ``work_book`` (a work's books, with the first place that
    its list names), ``chapter`` and ``all``. ``n`` counts references,
    ``n_chosen`` those of works in the chosen categories, ``works`` the works.
    Works without references count as works; references of unknown works don't
    count. The groupings are made from one scan and merged in one shuffle of
    partial sums.
    """
    meta = works.select("id", or_else(F.col("author"), "Unknown").alias("author"), or_else(F.col("category"), "Other").alias("category"))
    cited = refs.select(F.col("manuscript_id").alias("id"), "book", "book_slug", "chapter").join(meta, "id").withColumn("ref", F.lit(1))
    rows = cited.unionByName(meta.withColumn("ref", F.lit(0)), allowMissingColumns=True)
    columns = ["author", "category", "id", "book", "book_slug", "chapter"]
    chosen = F.col("category").isin(categories) if categories else F.lit(False)
    place = F.when(F.col("ref") == 1, F.struct("book_slug", "chapter"))
    # What is aggregated must not be what is grouped, which a grouping set empties.
    rows = rows.withColumn("chosen_", F.when(chosen & (F.col("ref") == 1), 1).otherwise(0)).withColumn("place_", place).withColumn("work_", 1 - F.col("ref"))
    told = rows.groupingSets([[F.col(c) for c in s] for s in SETS.values()], *columns).agg(
        F.grouping_id().alias("set_"), F.sum("ref").cast("bigint").alias("n"), F.sum("chosen_").cast("bigint").alias("n_chosen"), F.sum("work_").cast("bigint").alias("works"), F.min("place_").alias("first")
    )
    name = F.lit(None).cast("string")
    for facet, kept in SETS.items():
        # A column that a set leaves out is a one, the first column the highest.
        mask = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in kept)
        name = F.when(F.col("set_") == mask, facet).otherwise(name)
    out = told.select(name.alias("facet"), *columns, "n", "n_chosen", "works", F.col("first.book_slug").alias("first_slug"), F.col("first.chapter").alias("first_chapter"))
    # Works alone have no book and no chapter.
    return out.where(~F.col("facet").isin("work_book", "chapter") | (F.col("n") > 0))
