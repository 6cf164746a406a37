"""Queries of files that are written from the given tables and read again, and of table functions, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import registry
from ..functions.scalars import escaped
from ..functions.storage import shared_dir
from ..operators import citations, rollups, store
from ..sources import files, texts, thml
from .catalog import _JOINED, _SEGMENTS, query
from .synth import Views


def _folder(v: Views, name: str) -> str:
    return f"{shared_dir(v.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _name(v: Views) -> F.Column:
    return F.concat(F.lit("d_"), F.col("doc_id").cast("string"), F.lit(".txt"))


#: Every third file has the line ends of one system, every third those of another, and every fourth ends in what is no UTF-8.
_ENDS_SQL = "CASE WHEN doc_id % 3 = 0 THEN replace(coalesce(text, ''), chr(10), chr(13) || chr(10)) WHEN doc_id % 3 = 1 THEN replace(coalesce(text, ''), chr(10), chr(13)) ELSE coalesce(text, '') END"


def _write_documents(v: Views) -> str:
    """The documents as files of a folder."""
    files.register(v.spark)
    text, n = F.coalesce("text", F.lit("")), F.col("doc_id")
    ended = F.when(n % 3 == 0, F.replace(text, F.lit("\n"), F.lit("\r\n"))).when(n % 3 == 1, F.replace(text, F.lit("\n"), F.lit("\r"))).otherwise(text).cast("binary")
    body = F.when(n % 4 == 1, F.concat(ended, F.lit(bytearray(b"\xc3(\xff")))).otherwise(ended)
    path = _folder(v, "texts")
    v.dealt("documents").select(_name(v).alias("filename"), body.alias("content")).write.format("texts").mode("append").save(path)
    return path


_FILES_SQL = f"""files AS (SELECT 'd_' || doc_id || '.txt' AS filename, strlen({_ENDS_SQL}) + CASE WHEN doc_id % 4 = 1 THEN 3 ELSE 0 END AS length,
  regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') || CASE WHEN doc_id % 4 = 1 THEN chr(65533) || '(' || chr(65533) ELSE '' END AS text FROM documents)"""
_TOLD = "filename, CAST(length AS BIGINT) AS length, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS told"


@query(f"SELECT {_TOLD} FROM files WHERE length > 1000", _FILES_SQL)
def text_files(v: Views) -> DataFrame:
    """The documents' files, read by the data source of texts; those of 1,000 bytes and less are passed over."""
    rows = v.spark.read.format("texts").option("path", _write_documents(v)).option("partitionBytes", 1 << 20).load()
    return rows.select("filename", "length", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("told"))


@query("SELECT filename, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS told FROM files WHERE length > 1000", _FILES_SQL)
def text_files_natively(v: Views) -> DataFrame:
    """The same files by Spark's reader of whole files."""
    rows = texts.read_texts(v.spark, _write_documents(v))
    return rows.select("filename", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("told"))


@query("""SELECT 'a' || s_suppkey % 20 AS author_id, 'b' || s_suppkey AS book_id, CASE WHEN s_suppkey % 3 = 0 THEN 'downloaded' ELSE 'cached' END AS status, 'p' || s_suppkey AS local_path
FROM supplier WHERE s_suppkey % 3 <> 2 AND s_suppkey % 7 <> 1""")
def manifest_scan(v: Views) -> DataFrame:
    """Manifests, some entries without a path, as files that each hold a list."""
    n = F.col("s_suppkey")
    path = F.when(n % 7 == 1, F.when(n % 2 == 0, F.lit(""))).otherwise(F.concat(F.lit("p"), n.cast("string")))
    entry = F.struct(
        F.concat(F.lit("a"), (n % 20).cast("string")).alias("author_id"), F.concat(F.lit("b"), n.cast("string")).alias("book_id"), F.col("s_name").alias("title"), F.lit("u").alias("work_url"),
        F.when(n % 3 == 0, "downloaded").when(n % 3 == 1, "cached").otherwise("failed").alias("status"), path.alias("local_path"), F.lit(None).cast("string").alias("source_url"),
    )
    to = _folder(v, "manifest")
    listed = v.raw("supplier").groupBy(F.floor(n / 100)).agg(F.collect_list(entry).alias("all"))
    listed.select(F.to_json("all", {"pretty": "true"}).alias("value")).repartition(4).write.text(to, lineSep="\u0003")
    return texts.read_manifest(v.spark, to).select("author_id", "book_id", "status", "local_path")


@query("""SELECT 'b' || doc_id || '.txt' AS filename, sha256(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') || ' see Rom!') AS told FROM documents""")
def clean_text_files(v: Views) -> DataFrame:
    """The clean texts of annotated documents, written beside their names and read as texts."""
    files.register(v.spark)
    number = F.col("doc_id").cast("string")
    xml = F.concat(F.lit("<ThML><ThML.head><DC.Title>T</DC.Title></ThML.head><ThML.body><p>"), escaped(F.col("text")), F.lit("<note>skip</note> see <scripRef parsed=\"|Romans|8|13|8|17\">Rom</scripRef>!</p></ThML.body></ThML>"))
    docs = v.dealt("documents").select(F.concat(F.lit("b"), number, F.lit(".xml")).alias("path"), xml.alias("content"))
    to = _folder(v, "clean")
    texts.write_text_files(thml.parse(docs), to)
    rows = v.spark.read.format("texts").option("path", to).option("leastBytes", 0).load()
    return rows.select("filename", F.sha2(F.col("text").cast("binary"), 256).alias("told"))


@query("SELECT id, filename, CAST(NULL AS VARCHAR) AS category, 'txt' AS source_format FROM works WHERE id % 2 = 0 UNION ALL SELECT id, filename, category, CASE WHEN id % 3 = 0 THEN 'txt' ELSE source_format END FROM works WHERE id % 2 = 1")
def migrated_works(v: Views) -> DataFrame:
    """Tables of two older layouts: without the columns that came later, and with nulls in one of them."""
    first = store.migrated(v.works.where("id % 2 = 0").drop("category", "source_format"))
    second = store.migrated(v.works.where("id % 2 = 1").withColumn("source_format", F.expr("CASE WHEN id % 3 <> 0 THEN source_format END")))
    columns = ["id", "filename", "category", "source_format"]
    return first.select(*columns).unionByName(second.select(*columns))


@query(
    "SELECT path, parsed, CAST(13 AS INT) AS citation_offset, book, book_slug, chapter, CASE WHEN vs > 0 THEN vs END AS verse_start, CASE WHEN ve > 0 AND ve <> vs THEN ve END AS verse_end FROM decoded WHERE chapter >= 1 AND vs IS NOT NULL AND ve IS NOT NULL",
    _SEGMENTS.replace("'a/' || l_orderkey || '.xml'", "'h/' || l_orderkey || '-' || i").replace("unnest(string_split(parsed, ';')) AS s FROM attributes", "unnest(string_split(parsed, ';')) AS s FROM (SELECT *, unnest([0, 1]) AS i FROM attributes)"),
)
def thml_hits_by_sql(v: Views) -> DataFrame:
    """The annotations of documents, each twice, as a lateral table function gives them, a row a hit."""
    registry.register(v.spark)
    hit = lambda i: F.concat(F.lit("<scripRef parsed=\""), F.col("parsed"), F.lit("\">here</scripRef>"))
    xml = F.concat(F.lit("<ThML><ThML.head><x>no</x></ThML.head><body><p>Words &amp; then "), hit(0), F.lit("<note>skipped "), hit(0), F.lit("</note></p></body></ThML>"))
    both = v.attributes.select(F.col("l_orderkey"), F.explode(F.array(F.lit(0), F.lit(1))).alias("i"), xml.alias("content"))
    both.select(F.concat(F.lit("h/"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("i").cast("string")).alias("path"), "content").createOrReplaceTempView("annotated_")
    return citations.decode_attribute(v.spark.sql("SELECT path, h.* FROM annotated_, LATERAL thml_hits(content) h"))


@query(f"SELECT 'w' || w.id || '.json' AS filename, w.id, coalesce(nullif(author, ''), 'Unknown') AS author, year, count(*) AS n_refs, min(book_slug) AS first_book FROM {_JOINED} GROUP BY ALL")
def work_files(v: Views) -> DataFrame:
    """Each work's payload as a compressed file of its own, and what the files hold."""
    to = _folder(v, "works")
    texts.write_documents(rollups.work_payloads(v.refs, v.works), to, F.concat(F.lit("w"), F.col("id").cast("string")))
    said = "id bigint, author string, year int, refs array<struct<book_slug:string>>"
    rows = texts.read_documents(v.spark, to).select("filename", F.from_json("value", said).alias("w")).select("filename", "w.*")
    return rows.select("filename", "id", "author", "year", F.size("refs").cast("bigint").alias("n_refs"), F.col("refs")[0]["book_slug"].alias("first_book"))
