"""Interactive views over references, works and passages as parameterised queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bucket, bucket_width, heat, mentions, or_else, percent, verse_key, verse_label
from .rollups import chapter_category_counts, dimension, in_canon, joined, labelled, last_if_null, work_counts


def chosen(column: Column, categories: list[str]) -> Column:
    """The row's category is among the chosen ones; null and empty count as Other."""
    return or_else(column, "Other").isin(categories) if categories else F.lit(False)


def filtered_chapters(refs: DataFrame, works: DataFrame, categories: list[str]) -> DataFrame:
    """book_slug, book, book_order, chapter, n over the chosen categories; the shared base of the views."""
    counts = chapter_category_counts(refs, works)
    picked = counts.where(F.col("category").isin(categories)) if categories else counts.limit(0)
    return in_canon(picked.groupBy("book_slug", "chapter").agg(F.sum("n").alias("n"))).select("book_slug", "book", "book_order", "chapter", "n")


def welcome(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Totals over the index: references, books, works."""
    totals = in_canon(chapter_category_counts(refs, works))
    return totals.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("refs"), F.count_distinct("book_slug").alias("books")).crossJoin(work_counts(refs, works).agg(F.count("*").alias("works")))


def sidebar(base: DataFrame, term: str = "") -> DataFrame:
    """Books with their total and largest chapter under the filter; empty ones go."""
    return base.where(mentions(term, F.col("book"))).groupBy("book_slug", "book", "book_order").agg(F.sum("n").alias("total"), F.max("n").alias("most"))


def verse_table(refs: DataFrame, works: DataFrame, slug: str, chapter: int, categories: list[str]) -> DataFrame:
    """verse_key, n, heat of one chapter; ``whole`` first, then by number."""
    picked = joined(refs.where((F.col("book_slug") == slug) & (F.col("chapter") == chapter)), works).where(chosen(F.col("category"), categories))
    n = picked.groupBy(verse_key(verse_label(F.col("verse_start"), F.col("verse_end"))).alias("verse_key")).agg(F.count("*").alias("n"))
    most = n.agg(F.max("n").alias("most"))
    return n.crossJoin(F.broadcast(most)).select("verse_key", "n", heat(F.col("n"), F.col("most")).alias("heat")).orderBy(F.col("verse_key") != "whole", F.col("verse_key").try_cast("int"))


def author_facet(refs: DataFrame, works: DataFrame) -> DataFrame:
    return work_counts(refs, works).select("author").distinct().orderBy("author")


def category_facet(works: DataFrame) -> DataFrame:
    return works.select(or_else(F.col("category"), "Other").alias("category")).distinct().orderBy("category")


def book_facet(refs: DataFrame, work_id: int) -> DataFrame:
    """Books of a work in the order in which its list first names them."""
    mine = refs.where(F.col("manuscript_id") == work_id)
    return mine.groupBy("book").agg(F.min(F.struct("book_slug", "chapter")).alias("first")).orderBy("first").select("book", F.col("first.book_slug").alias("book_slug"), F.col("first.chapter").alias("chapter"))


def coverage(base: DataFrame) -> DataFrame:
    """Total of each book of the canon and its heat against the largest (at least 1)."""
    total = base.groupBy("book_slug").agg(F.sum("n").alias("total"))
    all_books = dimension(base).select(F.col("slug").alias("book_slug"), "book_order").join(total, "book_slug", "left").select("book_slug", "book_order", F.coalesce("total", F.lit(0)).cast("bigint").alias("total"))
    most = all_books.agg(F.greatest(F.lit(1), F.max("total")).alias("most"))
    return all_books.crossJoin(F.broadcast(most)).select("book_slug", "total", heat(F.col("total"), F.col("most")).alias("heat"))


def category_share(counts: DataFrame) -> DataFrame:
    """category, n, percent, and the running start of each slice in order of category."""
    n = counts.groupBy("category").agg(F.sum("n").alias("n"))
    whole = n.agg(F.sum("n").alias("whole"))
    upto = Window.orderBy("category").rowsBetween(Window.unboundedPreceding, -1)
    return n.crossJoin(F.broadcast(whole)).select("category", "n", percent(F.col("n"), F.col("whole")).alias("percent"), F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("bigint").alias("start"))


def group_counts(refs: DataFrame) -> DataFrame:
    """References of each work by group of books; unknown books fall to the middle group."""
    c = dimension(refs).select(F.col("slug").alias("book_slug"), "book_group")
    return refs.join(c, "book_slug", "left").groupBy("manuscript_id", F.coalesce("book_group", F.lit("Deuterocanon")).alias("book_group")).agg(F.count("*").alias("n"))


def dated(works: DataFrame, categories: list[str]) -> DataFrame:
    """Works with a year in the chosen categories, with their bucket; its width follows from all their years."""
    picked = works.where(F.col("year").isNotNull() & chosen(F.col("category"), categories)).select("id", "year")
    width = picked.agg(bucket_width(F.max("year") - F.min("year")).alias("width"))
    return picked.crossJoin(F.broadcast(width)).select("id", "year", "width", bucket(F.col("year"), F.col("width")).alias("bucket"))


def bucket_shares(refs: DataFrame, works: DataFrame, categories: list[str]) -> DataFrame:
    """bucket, book_group, n, share of the bucket and the share before it in the order of groups."""
    order = dimension(refs).groupBy("book_group").agg(F.min("group_order").alias("group_order"))
    n = group_counts(refs).join(dated(works, categories).select(F.col("id").alias("manuscript_id"), "bucket"), "manuscript_id").groupBy("bucket", "book_group").agg(F.sum("n").alias("n"))
    n = n.join(F.broadcast(order), "book_group")
    whole, upto = Window.partitionBy("bucket"), Window.partitionBy("bucket").orderBy("group_order").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(whole)
    return n.select("bucket", "book_group", "n", (F.col("n") / total).alias("share"), (F.coalesce(F.sum("n").over(upto), F.lit(0)) / total).alias("start"))


def book_grid(refs: DataFrame, works: DataFrame, categories: list[str], top: int = 20) -> DataFrame:
    """book_slug, bucket, n of the most cited books over dated works."""
    pairs = refs.select("manuscript_id", "book_slug").join(dated(works, categories).select(F.col("id").alias("manuscript_id"), "bucket"), "manuscript_id")
    grid = pairs.groupBy("book_slug", "bucket").agg(F.count("*").alias("n"))
    c = dimension(refs).select(F.col("slug").alias("book_slug"), "book_order")
    first = grid.groupBy("book_slug").agg(F.sum("n").alias("total")).join(c, "book_slug").orderBy(F.desc("total"), "book_order").limit(top)
    return grid.join(F.broadcast(first.select("book_slug", "book_order")), "book_slug").select("book_slug", "book_order", "bucket", "n")


def stream_layout(grid: DataFrame, height: float = 400.0) -> DataFrame:
    """Top and bottom of each book's stream at each bucket, stacked in canonical order around the middle."""
    totals = grid.groupBy("bucket").agg(F.sum("n").alias("total"))
    most = totals.agg(F.max("total").alias("most"))
    upto = Window.partitionBy("bucket").orderBy("book_order").rowsBetween(Window.unboundedPreceding, -1)
    scaled = grid.join(totals, "bucket").crossJoin(F.broadcast(most)).withColumn("scale", F.lit(height) / F.col("most"))
    top = F.lit(height / 2) - F.col("total") * F.col("scale") / 2 + F.coalesce(F.sum("n").over(upto), F.lit(0)) * F.col("scale")
    return scaled.select("book_slug", "bucket", "n", top.alias("top"), (top + F.col("n") * F.col("scale")).alias("bottom"))


def widest_bucket(grid: DataFrame) -> DataFrame:
    """The bucket in which each book is cited most, the earliest of equals."""
    return grid.groupBy("book_slug").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col("bucket"))).alias("w")).select("book_slug", F.col("w.bucket").alias("bucket"), (-F.col("w.m")).alias("n"))


def top_chapters(base: DataFrame, k: int = 30) -> DataFrame:
    return base.orderBy(F.desc("n"), "book_order", "chapter").limit(k).select("book", "chapter", "n")


def top_books(base: DataFrame, k: int = 20) -> DataFrame:
    return base.groupBy("book", "book_order").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "book_order").limit(k).select("book", "total")


def timeline(refs: DataFrame, works: DataFrame, categories: list[str]) -> DataFrame:
    """Dated works with references in order of year, and how many of the chosen are undated."""
    picked = work_counts(refs, works).where(chosen(F.col("category"), categories))
    undated = picked.agg(F.count(F.when(F.col("year").isNull(), 1)).alias("undated"))
    return picked.where("year is not null").crossJoin(F.broadcast(undated)).select("id", "year", "ref_count", "undated").orderBy("year", "id")


def first_chapter(base: DataFrame) -> DataFrame:
    return base.where("n > 0").groupBy("book_slug").agg(F.min("chapter").alias("chapter"))


def chapter_listing(refs: DataFrame, works: DataFrame, passages: DataFrame | None, slug: str, chapter: int, verse: str = "", author: str = "", categories: list[str] | None = None) -> DataFrame:
    """References of a chapter in order of verse, author, title, with their passages; optional filters.

    References of unknown works go; a missing passage is empty.
    """
    rows = labelled(refs.where((F.col("book_slug") == slug) & (F.col("chapter") == chapter)), works)
    if verse:
        rows = rows.where(verse_key(F.col("v")) == verse)
    if author:
        rows = rows.where(or_else(F.col("author"), "Unknown") == author)
    if categories is not None:
        rows = rows.where(chosen(F.col("category"), categories))
    if passages is not None:
        rows = rows.join(passages, ["filename", "passage_start_offset", "passage_end_offset"], "left").withColumn("passage", F.coalesce("passage", F.lit("")))
    return rows.orderBy(last_if_null("verse_start"), "author", "title", "w")


def work_listing(refs: DataFrame, works: DataFrame, work_id: int, slug: str = "") -> DataFrame:
    """References of a work in order of book, chapter, verse, with their place as text."""
    rows = labelled(refs.where((F.col("manuscript_id") == work_id) & (F.lit(slug == "") | (F.col("book_slug") == slug))), works)
    place = F.concat(F.col("book"), F.lit(" "), F.col("chapter").cast("string"), F.coalesce(F.concat(F.lit(":"), F.col("v")), F.lit("")))
    return rows.withColumn("place", place).orderBy("book_slug", "chapter", last_if_null("verse_start"))


def search_works(refs: DataFrame, works: DataFrame, term: str = "", categories: list[str] | None = None) -> DataFrame:
    """Works whose author and title contain the term; no chosen category means all."""
    rows = work_counts(refs, works).where(mentions(term, F.col("author"), F.col("title")))
    return rows.where(chosen(F.col("category"), categories)) if categories else rows


def with_verse_text(keys: DataFrame, verses: DataFrame) -> DataFrame:
    """Rows of (book_slug, chapter, verse_key) with the verse's text where it is known."""
    v = verses.select(F.col("slug").alias("book_slug"), "chapter", F.col("verse").cast("string").alias("verse_key"), F.col("text").alias("verse_text"))
    return keys.join(v, ["book_slug", "chapter", "verse_key"], "left")
