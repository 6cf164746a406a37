"""Queries of the text index, facets and change feeds, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import shared_dir
from ..operators import changes, facets, rollups
from ..operators.search import TextIndex
from .catalog import _CATEGORY, _COUNTED, _IN, _JOINED, CHOSEN, query
from .synth import Views


def _index(v: Views) -> TextIndex:
    return TextIndex(v.spark, f"{shared_dir(v.spark).rstrip('/')}/text-index-{uuid.uuid4().hex}")


_WORK_TERMS = """terms AS (SELECT DISTINCT term FROM (SELECT substr(filename, CAST(id % 4 + 1 AS INT), CAST(id % 6 + 1 AS INT)) AS term FROM works
  UNION ALL SELECT upper(substr(coalesce(author, 'Unknown'), CAST(id % 5 + 1 AS INT), CAST(id % 8 AS INT))) FROM works
  UNION ALL SELECT substr(author || ' ' || title, 4, CAST(10 + id % 9 AS INT)) FROM works) WHERE term IS NOT NULL)"""


@query("SELECT term, id FROM terms JOIN (SELECT id, lower(coalesce(nullif(author, ''), 'Unknown') || ' ' || coalesce(nullif(title, ''), filename)) AS said FROM works JOIN counted USING (id)) ON contains(said, lower(term))", f"{_COUNTED}, {_WORK_TERMS}")
def search_batch(v: Views) -> DataFrame:
    """A batch of terms, short and empty ones too, over the works that cite."""
    works = rollups.work_counts(v.refs, v.works)
    index = _index(v).build(works, "id", F.col("author"), F.col("title"))
    some = lambda text, start, size: F.substring(text, start, size).alias("term")
    number, whole = F.col("id"), F.concat("author", F.lit(" "), "title")
    terms = v.works.select(some(F.col("filename"), (number % 4 + 1).cast("int"), (number % 6 + 1).cast("int"))).unionByName(
        v.works.select(F.upper(some(F.coalesce("author", F.lit("Unknown")), (number % 5 + 1).cast("int"), (number % 8).cast("int"))).alias("term"))
    ).unionByName(v.works.select(some(whole, F.lit(4), (10 + number % 9).cast("int"))))
    return index.search(terms).withColumnRenamed("key", "id")


_ITEM_TERMS = """terms AS (SELECT DISTINCT unnest([substr(text, CAST(1 + item_id % 20 AS INT), CAST(8 + item_id % 40 AS INT)), substr(text, 30, 5)]) AS term FROM benchmark WHERE text IS NOT NULL)"""


@query("SELECT term, doc_id FROM terms JOIN documents ON contains(lower(coalesce(text, '')), lower(term))", _ITEM_TERMS)
def search_documents(v: Views) -> DataFrame:
    """Pieces of the benchmark's items over the whole documents."""
    index = _index(v).build(v.dealt("documents"), "doc_id", F.col("text"))
    number, text = F.col("item_id"), F.col("text")
    pieces = F.array(F.substring(text, (1 + number % 20).cast("int"), (8 + number % 40).cast("int")), F.substring(text, 30, 5))
    return index.search(v.raw("benchmark").where("text is not null").select(F.explode(pieces).alias("term"))).withColumnRenamed("key", "doc_id")


@query(
    f"""SELECT 'author' AS facet, author, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS book, CAST(NULL AS VARCHAR) AS book_slug, CAST(NULL AS INT) AS chapter, CAST(sum(n) AS BIGINT) AS n,
    CAST(sum(n_chosen) AS BIGINT) AS n_chosen, count(*) AS works, min(first_slug) AS first_slug, CAST(arg_min(first_chapter, first_slug || lpad(CAST(first_chapter AS VARCHAR), 9, '0')) AS INT) AS first_chapter FROM per GROUP BY author
  UNION ALL SELECT 'category', NULL, category, NULL, NULL, NULL, NULL, sum(n), sum(n_chosen), count(*), min(first_slug), arg_min(first_chapter, first_slug || lpad(CAST(first_chapter AS VARCHAR), 9, '0')) FROM per GROUP BY category
  UNION ALL SELECT 'all', NULL, NULL, NULL, NULL, NULL, NULL, sum(n), sum(n_chosen), count(*), min(first_slug), arg_min(first_chapter, first_slug || lpad(CAST(first_chapter AS VARCHAR), 9, '0')) FROM per
  UNION ALL SELECT 'work_book', NULL, NULL, manuscript_id, book, NULL, NULL, count(*), count(*) FILTER (chosen), 0, min(book_slug), min(chapter) FROM told GROUP BY manuscript_id, book
  UNION ALL SELECT 'chapter', NULL, NULL, NULL, NULL, book_slug, chapter, count(*), count(*) FILTER (chosen), 0, book_slug, chapter FROM told GROUP BY book_slug, chapter""",
    f"""told AS (SELECT manuscript_id, book, book_slug, chapter, {_CATEGORY} IN ({_IN}) AS chosen FROM {_JOINED}),
  per AS (SELECT w.id, coalesce(nullif(w.author, ''), 'Unknown') AS author, coalesce(nullif(w.category, ''), 'Other') AS category, count(t.manuscript_id) AS n, count(*) FILTER (chosen) AS n_chosen,
    min(book_slug) AS first_slug, arg_min(t.chapter, book_slug || lpad(CAST(t.chapter AS VARCHAR), 9, '0')) AS first_chapter FROM works w LEFT JOIN told t ON t.manuscript_id = w.id GROUP BY ALL)""",
)
def facets_in_one_pass(v: Views) -> DataFrame:
    return facets.facets(v.refs, v.works, CHOSEN)


def _later(v: Views) -> DataFrame:
    """The works some time later: some are gone, some have another year or no title, some are new."""
    works = v.works.where("id % 10 <> 4").withColumn("year", F.expr("CASE WHEN id % 7 = 1 THEN year + 1 ELSE year END"))
    works = works.withColumn("title", F.expr("CASE WHEN id % 11 = 2 THEN NULL ELSE title END"))
    return works.unionByName(v.works.where("id % 9 = 3").withColumn("id", F.col("id") + 1_000_000))


_LATER = """later AS (SELECT id, filename, author, CASE WHEN id % 11 = 2 THEN NULL ELSE title END AS title, CAST(CASE WHEN id % 7 = 1 THEN year + 1 ELSE year END AS INT) AS year, ccel_url, category, source_format FROM works WHERE id % 10 <> 4
  UNION ALL SELECT id + 1000000, filename, author, title, year, ccel_url, category, source_format FROM works WHERE id % 9 = 3)"""


@query(
    """SELECT CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' ELSE 'update' END AS op, coalesce(n.id, o.id) AS id, n.filename, n.title, n.year FROM works o FULL JOIN later n ON o.id = n.id
  WHERE o.id IS NULL OR n.id IS NULL OR o.title IS DISTINCT FROM n.title OR o.year IS DISTINCT FROM n.year""",
    _LATER,
)
def works_feed(v: Views) -> DataFrame:
    """What changed between two states of the works."""
    return changes.feed(v.works, _later(v), ["id"]).select("op", "id", "filename", "title", "year")


@query("SELECT * FROM later", _LATER)
def works_feed_applied(v: Views) -> DataFrame:
    """The feed, applied twice to the old state."""
    told = changes.feed(v.works, _later(v), ["id"])
    return changes.applied(changes.applied(v.works, told, ["id"]), told, ["id"])


@query("SELECT manuscript_id, book_slug, count(*) AS n FROM refs WHERE manuscript_id % 3 <> 0 OR l_linenumber <> 2 GROUP BY ALL")
def references_feed_applied(v: Views) -> DataFrame:
    """References, many to a work, after a feed by work that takes some lines of every third."""
    old = v.refs
    told = changes.feed(old, old.where("manuscript_id % 3 <> 0 OR l_linenumber <> 2"), ["manuscript_id"])
    return changes.applied(old, told, ["manuscript_id"]).groupBy("manuscript_id", "book_slug").agg(F.count("*").alias("n"))
