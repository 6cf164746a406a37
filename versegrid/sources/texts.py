"""Text, link, manifest and verse sources, and the sinks of built payloads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canon import canon

# Works that no index lists, which are local only.
LOCAL_WORKS = [
    ("Meister Eckhart", "Sermons", "sermons.txt"),
    ("John Owen", "Of the Mortification of Sin in Believers", "mort.txt"),
    ("Richard Allestree", "The Government of the Tongue", "government.txt"),
    ("Alvin Plantinga", "Warranted Christian Belief", "warrant3.txt"),
]
#: Smallest file of a corpus, in bytes; smallest download, and where its first tag must be.
LEAST_TEXT, LEAST_XML, TAG_WITHIN = 1000, 500, 200
MANIFEST = "author_id string, book_id string, title string, work_url string, status string, local_path string, source_url string"
# Metadata that beats the files' headers wholesale, its nulls too.
OVERRIDES = [
    ("mort.txt", "John Owen", "Of the Mortification of Sin in Believers", 1656, "https://ccel.org/ccel/owen/mort"),
    ("government.txt", "Richard Allestree", "The Government of the Tongue", 1674, None),
    ("sermons.txt", "Meister Eckhart", "Sermons", 1300, None),
    ("warrant3.txt", "Alvin Plantinga", "Warranted Christian Belief", 2000, None),
]
SITE = "https://ccel.org/ccel"


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """filename, text of files above the least size: valid UTF-8 with single line ends."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).where(F.col("length") > LEAST_TEXT)
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("filename"), text.alias("text"))


def read_xml(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(folder).select("path", "content")


def text_works(texts: DataFrame) -> DataFrame:
    """filename, author, title, year, ccel_url of text files, from the overrides or else the header."""
    head = S.header(F.col("text"))
    own = texts.select("filename", S.header_author(head).alias("author"), S.field(head, "Title").alias("title"), S.header_year(head).alias("year"))
    stem = F.regexp_replace("filename", r"\.[^./]*$", "")
    own = own.withColumn("ccel_url", F.when(F.col("author").isNotNull(), S.work_url(stem, SITE)))
    over = texts.sparkSession.createDataFrame(OVERRIDES, "filename string, a string, t string, y int, u string")
    joined = own.join(F.broadcast(over.withColumn("there", F.lit(True))), "filename", "left")
    pick = lambda c, o: F.when(F.col("there"), F.col(o)).otherwise(F.col(c)).alias(c)
    return joined.select("filename", pick("author", "a"), pick("title", "t"), pick("year", "y"), pick("ccel_url", "u"))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, pos, href, label of every anchor with an address, in page order."""
    anchor = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all(F.col(html), F.lit(anchor), F.lit(0))).alias("pos", "tag"))
    label = S.strip(F.regexp_replace(F.regexp_extract("tag", anchor, 2), "<[^>]*>", ""))
    return rows.select("page_id", "pos", F.regexp_extract("tag", anchor, 1).alias("href"), label.alias("label"))


def _first(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key by page and place."""
    rest = [c for c in rows.columns if c not in keys]
    first = F.min(F.struct("page_id", "pos", *[c for c in rest if c not in ("page_id", "pos")])).alias("f")
    return rows.groupBy(*keys).agg(first).select(*keys, "f.*")


def text_index(found: DataFrame, prefix: str = "/ccel/") -> DataFrame:
    """Works that an index page links as ``prefix``author/work.html; first link of each, its label or author/work as title."""
    # The path has just three parts: the prefix's, author and file.
    m = rf"{prefix}([^/]+)/([^/]+)\.html$"
    rows = found.where(F.col("href").rlike(m)).select("page_id", "pos", F.regexp_extract("href", m, 1).alias("author_id"), F.regexp_extract("href", m, 2).alias("book_id"), "label")
    rows = rows.where(~F.col("author_id").contains("/"))
    return _first(rows, ["author_id", "book_id"]).select("author_id", "book_id", S.or_else(F.col("label"), F.concat_ws("/", "author_id", "book_id")).alias("title"))


# Fixed pattern: addresses of works in the annotated index.
XML_WORK = r"^/ccel/([^/]+)/([^/]+?)(?:\.[a-z]+)?$"


def xml_index(found: DataFrame, pattern: str = XML_WORK) -> DataFrame:
    """Works of the annotated index: query, fragment and trailing slashes off, first link of each pair."""
    href = F.regexp_replace(F.substring_index(F.substring_index("href", "?", 1), "#", 1), "/+$", "")
    rows = found.withColumn("href", href).where(F.col("href").rlike(pattern))
    rows = rows.select("page_id", "pos", F.regexp_extract("href", pattern, 1).alias("author_id"), F.regexp_extract("href", pattern, 2).alias("book_id"), "label", "href")
    return _first(rows, ["author_id", "book_id"]).select("author_id", "book_id", F.col("label").alias("title"), "href")


def text_link(found: DataFrame, site: str) -> DataFrame:
    """The first link of each page that ends in .txt, absolute."""
    rows = found.where(F.lower("href").endswith(".txt")).groupBy("page_id").agg(F.min(F.struct("pos", "href")).alias("f"))
    return rows.select("page_id", F.when(F.col("f.href").startswith("http"), F.col("f.href")).otherwise(F.concat(F.lit(site), F.col("f.href"))).alias("url"))


def all_works(discovered: DataFrame) -> DataFrame:
    """author, title, filename, txt_url of discovered works, then of the local ones; repeats stay."""
    local = discovered.sparkSession.createDataFrame([(*w, None) for w in LOCAL_WORKS], "author string, title string, filename string, txt_url string")
    return discovered.select(*local.columns).unionByName(local)


def crawl(index: DataFrame, manifest: DataFrame, limit: int = 0, force: bool = False) -> DataFrame:
    """The index's first ``limit`` works (0: all) in its order (page_id, pos), with the status that the manifest lets them have.

    Works that are downloaded or cached already are ``cached`` with their paths
    and need nothing, unless ``force`` is set; all others are ``wanted``.
    """
    rows = index.orderBy("page_id", "pos").limit(limit) if limit else index
    done = manifest.where(F.col("status").isin("downloaded", "cached")).select("author_id", "book_id", "local_path", "source_url", F.lit("cached").alias("status"))
    if force:
        done = done.limit(0)
    return rows.join(done, ["author_id", "book_id"], "left").withColumn("status", F.coalesce("status", F.lit("wanted")))


def first_download(candidates: DataFrame) -> DataFrame:
    """work, url of the first candidate (by pos) with status 200, enough bytes and a tag near its start."""
    fine = candidates.where((F.col("status") == 200) & (F.length("content") > LEAST_XML) & F.contains(F.substring(F.col("content").cast("string"), 1, TAG_WITHIN), F.lit("<")))
    return fine.groupBy("work").agg(F.min(F.struct("pos", "url")).alias("f")).select("work", F.col("f.url").alias("url"))


def to_download(discovered: DataFrame, present: DataFrame) -> DataFrame:
    """Discovered works that are not there yet."""
    return discovered.join(present.select("author_id", "book_id"), ["author_id", "book_id"], "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows with a document: downloaded or cached, with a path."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path).where(F.col("status").isin("downloaded", "cached") & (F.coalesce("local_path", F.lit("")) != ""))


def merged_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows win; works that were not tried again keep theirs."""
    return old.join(new.select("author_id", "book_id"), ["author_id", "book_id"], "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def manifest_summary(rows: DataFrame) -> DataFrame:
    count = lambda *s: F.count(F.when(F.col("status").isin(*s), 1))
    return rows.agg(count("downloaded").alias("downloaded"), count("cached").alias("cached"), count("failed").alias("failed"))


def write_texts(parsed: DataFrame, path: str) -> None:
    """The clean texts of walked documents beside their names, for builds that read passages by offset."""
    parsed.select(F.regexp_replace("path", r"\.[^./]*$", ".txt").alias("filename"), F.col("clean_text").alias("text")).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_text_files(parsed: DataFrame, folder: str) -> None:
    """The clean texts of walked documents as files under their names, by the data source of texts."""
    from .files import register

    register(parsed.sparkSession)
    name = F.regexp_replace("path", r"\.[^./]*$", ".txt").alias("filename")
    parsed.select(name, F.col("clean_text").alias("text")).write.format("texts").mode("append").save(folder)


VERSES = "struct<book:string,chapters:array<struct<chapter:string,verses:array<struct<verse:string,text:string>>>>>"


def verse_texts(documents: DataFrame, value: str = "value") -> DataFrame:
    """slug, chapter, verse, text from one JSON document a book; unknown books and broken documents go."""
    book = documents.select(F.from_json(value, VERSES).alias("b")).where("b.book is not null")
    rows = book.select("b.book", F.explode("b.chapters").alias("c")).select("book", "c.chapter", F.explode("c.verses").alias("v"))
    known = F.broadcast(canon(documents.sparkSession).select(F.lower("name").alias("k"), "slug"))
    return rows.join(known, F.lower("book") == F.col("k")).select("slug", F.col("chapter").try_cast("int").alias("chapter"), F.col("v.verse").try_cast("int").alias("verse"), S.strip(F.col("v.text")).alias("text"))


def write_verses(verses: DataFrame, path: str) -> None:
    """The verse dictionary for joins: a folder a book, in order of place, so that one book's or chapter's verses are read alone."""
    dealt = verses.repartitionByRange("slug", "chapter").sortWithinPartitions("slug", "chapter", "verse")
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("slug").parquet(path)


def read_verses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chapter int, verse int, text string, slug string").parquet(path).select("slug", "chapter", "verse", "text")


def as_json(payload: DataFrame, *, explicit_nulls: bool = True) -> DataFrame:
    """One JSON string a row; without nulls where they are not wanted."""
    return payload.select(F.to_json(F.struct(*payload.columns), {"ignoreNullFields": str(not explicit_nulls).lower()}).alias("value"))


def write_parquet(payload: DataFrame, path: str, by: str | None = None, level: str = "zstd") -> None:
    writer = payload.write.mode("overwrite").option("compression", level)
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_documents(payload: DataFrame, folder: str, name: Column) -> None:
    """One compressed JSON document a row, as a file under the row's name: what a viewer loads one by one. Nulls are written."""
    from .files import register

    register(payload.sparkSession)
    value = F.to_json(F.struct(*payload.columns), {"ignoreNullFields": "false"})
    payload.select(F.concat(name, F.lit(".json.zst")).alias("filename"), value.alias("text")).write.format("texts").mode("append").save(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, value) of the documents of a folder, unpacked."""
    from .files import register

    register(spark)
    rows = spark.read.format("texts").option("path", folder).option("pattern", "*.json.zst").option("leastBytes", 0).load()
    return rows.select("filename", F.col("text").alias("value"))


def packed(payload: DataFrame, name: Column, level: int = 19) -> DataFrame:
    """(name, content) with each row's JSON zstd-compressed, for a file sink."""
    @F.pandas_udf("binary")
    def compress(values: pd.Series) -> pd.Series:
        import zstandard

        c = zstandard.ZstdCompressor(level=level)
        return pd.Series([c.compress(v.encode()) for v in values])

    rows = payload.select(name.alias("name"), F.to_json(F.struct(*payload.columns), {"ignoreNullFields": "false"}).alias("value"))
    return rows.select("name", compress("value").alias("content"))


def unpacked(rows: DataFrame) -> DataFrame:
    """(name, value) of packed rows."""
    @F.pandas_udf("string")
    def expand(values: pd.Series) -> pd.Series:
        import zstandard

        d = zstandard.ZstdDecompressor()
        return pd.Series([d.decompress(bytes(v)).decode() for v in values])

    return rows.select("name", expand("content").alias("value"))

