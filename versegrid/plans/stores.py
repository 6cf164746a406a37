"""Queries of stored tables and built files over several steps, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import shared_dir
from ..operators import rollups
from ..sources.outputs import Output
from ..streaming import ingest
from .catalog import _JOINED, _citation_sql, query
from .synth import Views


def _folder(v: Views, name: str) -> str:
    return f"{shared_dir(v.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    """SELECT 'd' || doc_id || '.txt' AS filename, book_slug, chapter, verse_start, verse_end, citation_offset FROM (
  SELECT doc_id, book_slug, chapter, TRY_CAST(vs[1] AS INT) AS verse_start, CASE WHEN TRY_CAST(vs[len(vs)] AS INT) <> TRY_CAST(vs[1] AS INT) THEN TRY_CAST(vs[len(vs)] AS INT) END AS verse_end, CAST(place AS INT) AS citation_offset
  FROM numbered JOIN spelled USING (k) WHERE chapter BETWEEN 1 AND chapters
  UNION ALL SELECT doc_id, 'romans', 8, 13, NULL, CAST(length(text) + 8 AS INT) FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL) WHERE doc_id % 5 <> 0""",
    _citation_sql(),
)
def ingest_replay(v: Views) -> DataFrame:
    """All documents, then some with a citation more, then some without any, and the second batch once again."""
    store = ingest.references(v.spark, _folder(v, "ingest"), fanout=2)
    texts = v.raw("documents").select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), "text")
    more = texts.where("doc_id % 3 = 0").withColumn("text", F.concat("text", F.lit(" ;; see Romans 8:13.")))
    none = texts.where("doc_id % 5 = 0").withColumn("text", F.lit("Nothing is cited."))
    for number, batch in ((0, texts), (1, more), (2, none), (1, more)):
        ingest.take(store, batch, number)
    return store.current().select("filename", "book_slug", "chapter", "verse_start", "verse_end", "citation_offset")


_SIZES = "count(*) AS n_refs, min(manuscript_id) AS first_work FROM"


def _sizes(v: Views, output: Output) -> DataFrame:
    refs = F.transform("refs", lambda r: r["w"])
    return output.current().select("book_slug", "chapter", F.size("refs").cast("bigint").alias("n_refs"), F.array_min(refs).alias("first_work"))


def _built(v: Views) -> Output:
    output = Output(v.spark, _folder(v, "build"))
    output.draft().stage(rollups.chapter_payloads(v.refs, v.works)).publish()
    return output


@query(f"SELECT book_slug, chapter, {_SIZES} {_JOINED} WHERE book_slug <> 'romans' OR manuscript_id % 2 = 0 GROUP BY ALL")
def rebuilt_slice(v: Views) -> DataFrame:
    """All books, then one of them again from fewer references; a draft of another one that breaks off shows nowhere."""
    output = _built(v)
    fewer = v.refs.where("manuscript_id % 2 = 0")
    output.draft().stage(rollups.chapter_payloads(fewer, v.works, only="romans")).publish()
    output.draft().stage(rollups.chapter_payloads(fewer, v.works, only="genesis"))
    return _sizes(v, output)


@query(f"SELECT book_slug, chapter, {_SIZES} {_JOINED} WHERE manuscript_id % 2 = 0 AND length(book_slug) > 5 GROUP BY ALL")
def rebuilt_clean(v: Views) -> DataFrame:
    """All books, then a clean build in two stages of the books that are left; files of the others go."""
    output = _built(v)
    rows = rollups.chapter_payloads(v.refs.where("manuscript_id % 2 = 0 AND length(book_slug) > 5"), v.works)
    draft = output.draft().stage(rows.where("length(book_slug) > 6"))
    draft.stage(rows.where("length(book_slug) = 6")).publish(clean=True)
    output.sweep()
    return _sizes(v, output)


@query(f"""SELECT book_slug, CASE WHEN n = 0 THEN 'missing' WHEN book_slug LIKE '%s' THEN 'stale' ELSE 'built' END AS state
FROM (SELECT slug AS book_slug, count(manuscript_id) AS n FROM canon LEFT JOIN (SELECT * FROM {_JOINED} WHERE length(book_slug) > 5) r ON r.book_slug = slug GROUP BY slug) WHERE n > 0 OR book_slug NOT LIKE '%s'""")
def reconciled_books(v: Views) -> DataFrame:
    """What a build of the longer names has, against all books but those that end in an s."""
    output = Output(v.spark, _folder(v, "build"))
    output.draft().stage(rollups.chapter_payloads(v.refs.where("length(book_slug) > 5"), v.works)).publish()
    return output.reconciled(v.canon.where("slug NOT LIKE '%s'").select(F.col("slug").alias("book_slug")))
