"""Joins of references with works, counts, and the nested payloads built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.canon import canon
from ..functions.scalars import or_else, passage_key, verse_label
from .places import numbered


def dimension(refs: DataFrame) -> DataFrame:
    return F.broadcast(canon(refs.sparkSession))


def joined(refs: DataFrame, works: DataFrame) -> DataFrame:
    """References with their work's columns (as author, title, year, category, filename)."""
    w = works.select(F.col("id").alias("manuscript_id"), "filename", "author", "title", "year", "ccel_url", "category")
    return refs.join(w, "manuscript_id")


def chapter_category_counts(refs: DataFrame, works: DataFrame) -> DataFrame:
    """book_slug, chapter, category, n. A null category counts as Other, an empty one stays empty."""
    pairs = refs.select("manuscript_id", "book_slug", "chapter").join(works.select(F.col("id").alias("manuscript_id"), F.coalesce("category", F.lit("Other")).alias("category")), "manuscript_id")
    return pairs.groupBy("book_slug", "chapter", "category").agg(F.count("*").alias("n"))


def chapter_totals(counts: DataFrame) -> DataFrame:
    """book_slug, chapter, n and by_cat (category to count, in order of category)."""
    entries = F.array_sort(F.collect_list(F.struct("category", "n")))
    return counts.groupBy("book_slug", "chapter").agg(F.sum("n").alias("n"), F.map_from_entries(entries).alias("by_cat"))


def in_canon(totals: DataFrame) -> DataFrame:
    """Chapters that their book has, with the book's name and order."""
    c = dimension(totals).select(F.col("slug").alias("book_slug"), F.col("name").alias("book"), "book_order", "chapters")
    return totals.join(c, "book_slug").where(F.col("chapter").between(1, F.col("chapters")))


def work_counts(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Works with at least one reference: id, author, title, year, ccel_url, category, ref_count."""
    n = refs.groupBy(F.col("manuscript_id").alias("id")).agg(F.count("*").alias("ref_count"))
    return works.join(n, "id").select(
        "id", or_else(F.col("author"), "Unknown").alias("author"), or_else(F.col("title"), F.col("filename")).alias("title"), "year", "ccel_url", or_else(F.col("category"), "Other").alias("category"), "ref_count"
    )


def reference_counts(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Every work's id, filename and ref_count, 0 included."""
    n = refs.groupBy(F.col("manuscript_id").alias("id")).agg(F.count("*").alias("n"))
    return works.select("id", "filename").join(n, "id", "left").select("id", "filename", F.coalesce("n", F.lit(0)).cast("bigint").alias("ref_count"))


def without_references(refs: DataFrame, works: DataFrame) -> DataFrame:
    return works.join(refs.select(F.col("manuscript_id").alias("id")), "id", "left_anti")


def referenced_files(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Distinct files of works that have references, under the corpus folder."""
    files = works.join(refs.select(F.col("manuscript_id").alias("id")), "id", "left_semi").select("filename").distinct()
    return files.select(F.when(F.col("filename").startswith("manuscripts/"), F.col("filename")).otherwise(F.concat(F.lit("manuscripts/"), F.col("filename"))).alias("path")).where(F.col("path").endswith(".txt"))


def build_totals(refs: DataFrame, works: DataFrame) -> DataFrame:
    """Book files and references of a build; unknown books have no file."""
    known = refs.join(dimension(refs).select(F.col("slug").alias("book_slug")), "book_slug").join(works.select(F.col("id").alias("manuscript_id")), "manuscript_id")
    return known.agg(F.count_distinct("book_slug").alias("files"), F.count("*").alias("refs"))


def table_counts(refs: DataFrame, works: DataFrame) -> DataFrame:
    return works.agg(F.count("*").alias("works")).crossJoin(refs.agg(F.count("*").alias("refs")))


def format_counts(works: DataFrame) -> DataFrame:
    """Works of either source format, 0 included: one pass, two counters."""
    n = works.agg(*[F.count(F.when(F.coalesce("source_format", F.lit("txt")) == f, 1)).alias(f) for f in ("txt", "thml")])
    return n.select(F.explode(F.create_map(F.lit("txt"), F.col("txt"), F.lit("thml"), F.col("thml"))).alias("source_format", "n"))


def category_tally(works: DataFrame) -> DataFrame:
    return works.groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def top_chapters(refs: DataFrame, k: int = 20) -> DataFrame:
    """The most cited chapters: by count, then canonical order."""
    n = refs.groupBy("book_slug", "chapter").agg(F.count("*").alias("n"))
    c = dimension(refs).select(F.col("slug").alias("book_slug"), F.col("name").alias("book"), "book_order")
    return n.join(c, "book_slug").orderBy(F.desc("n"), "book_order", "chapter").limit(k).select("book", "chapter", "n")


def book_slugs(refs: DataFrame, only: str = "") -> DataFrame:
    picked = refs if only == "" else refs.where(F.col("book_slug") == only)
    return picked.select("book_slug").distinct().orderBy("book_slug")


def labelled(refs: DataFrame, works: DataFrame) -> DataFrame:
    """References as the payloads list them: v (label), w (work), p (passage key)."""
    return joined(refs, works).withColumn("v", verse_label(F.col("verse_start"), F.col("verse_end"))).withColumn("p", passage_key(F.col("filename"), F.col("passage_start_offset"), F.col("passage_end_offset"))).withColumn("w", F.col("manuscript_id"))


def _listed(order: list[Column], fields: list[str]) -> Column:
    """List of structs in the order of some columns; ties by the fields themselves, so reruns agree."""
    keyed = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(*fields).alias("ref"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["ref"])


def last_if_null(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(2_147_483_647))


def chapter_payloads(refs: DataFrame, works: DataFrame, only: str = "") -> DataFrame:
    """book_slug, book, chapter, refs in order of verse, author, title; of one book where ``only`` names it.

    The form to write at scale, by book_slug: no row holds more than a chapter.
    """
    picked = refs.where(F.col("book_slug") == only) if only else refs
    rows = labelled(picked, works).withColumn("author_", F.coalesce("author", F.lit(""))).withColumn("title_", F.coalesce("title", F.lit("")))
    by_chapter = rows.groupBy("book_slug", "chapter").agg(_listed([last_if_null("verse_start"), F.col("author_"), F.col("title_")], ["v", "w", "p"]).alias("refs"))
    c = dimension(refs).select(F.col("slug").alias("book_slug"), F.col("name").alias("book"))
    return by_chapter.join(c, "book_slug").select("book_slug", "book", "chapter", "refs")


def book_payloads(refs: DataFrame, works: DataFrame, only: str = "") -> DataFrame:
    """book_slug, book, chapters: array of (ch, refs): one document a book, for files that a browser loads."""
    chapters = F.array_sort(F.collect_list(F.struct(F.col("chapter").alias("ch"), "refs"))).alias("chapters")
    return chapter_payloads(refs, works, only).groupBy("book_slug", "book").agg(chapters)


def work_references(refs: DataFrame, works: DataFrame) -> DataFrame:
    """id, place (from 1, in order of book, chapter, verse), book, book_slug, chapter, v, p: one row a reference.

    Places are counted from partial counts by work and book, so that a work of
    very many references is numbered book by book.
    """
    rows = labelled(refs, works).select(F.col("manuscript_id").alias("id"), "book", "book_slug", "chapter", "v", "p", last_if_null("verse_start").alias("s"))
    sizes = rows.groupBy("id", "book_slug").agg(F.count("*").alias("n"))
    first = sizes.select("id", "book_slug", (F.sum("n").over(Window.partitionBy("id").orderBy("book_slug")) - F.col("n")).alias("first"))
    at = F.row_number().over(Window.partitionBy("id", "book_slug").orderBy("chapter", "s", "book", "v", "p"))
    return rows.withColumn("at", at).join(first, ["id", "book_slug"]).select("id", (F.col("first") + F.col("at")).cast("bigint").alias("place"), "book", "book_slug", "chapter", "v", "p")


def work_payloads(refs: DataFrame, works: DataFrame) -> DataFrame:
    """id, author, title, year, ccel_url, refs in order of book, chapter, verse; one pass for all works."""
    listed = labelled(refs, works).groupBy(F.col("manuscript_id").alias("id")).agg(_listed([F.col("book_slug"), F.col("chapter"), last_if_null("verse_start")], ["book", "book_slug", "chapter", "v", "p"]).alias("refs"))
    meta = works.select("id", or_else(F.col("author"), "Unknown").alias("author"), or_else(F.col("title"), F.col("filename")).alias("title"), "year", "ccel_url")
    return meta.join(listed, "id")


def index_books(refs: DataFrame, works: DataFrame) -> DataFrame:
    """book_order, book_slug, book, chapters, place, chapter, n, by_cat (as JSON): one row a chapter that is cited, in canonical order."""
    totals = in_canon(chapter_totals(chapter_category_counts(refs, works)))
    place = F.row_number().over(Window.partitionBy("book_slug").orderBy("chapter"))
    return totals.select("book_order", "book_slug", "book", "chapters", place.alias("place"), "chapter", "n", F.to_json("by_cat").alias("by_cat"))


def index_works(refs: DataFrame, works: DataFrame) -> DataFrame:
    """place (from 1, by author, title, id), id, author, title, year, ccel_url, category, ref_count: one row a work that cites.

    The form to write at scale: places come from ranges, and no row or task holds all works.
    """
    return numbered(work_counts(refs, works), ["author", "title", "id"])


def index_payload(refs: DataFrame, works: DataFrame) -> DataFrame:
    """:func:`index_books` and :func:`index_works` nested into one row, as a small viewer loads them."""
    counts = F.array_sort(F.collect_list(F.struct(F.col("chapter").alias("ch"), F.col("n").alias("count"), "by_cat")))
    books = index_books(refs, works).groupBy("book_order", "book_slug", "book", "chapters").agg(counts.alias("counts"))
    all_books = books.agg(F.array_sort(F.collect_list(F.struct("book_order", "book_slug", "book", "chapters", "counts"))).alias("books"))
    listed = work_counts(refs, works).agg(F.array_sort(F.collect_list(F.struct("author", "title", "id", "year", "ccel_url", "category", "ref_count"))).alias("works"))
    return all_books.crossJoin(listed)
