"""Every query over the views with the SQL that gives the same rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canon import abbreviations, canon, int_to_roman, roman_to_int
from ..functions.storage import shared_dir
from ..operators import citations, classify, explore, highlight, rollups, store, windows
from ..sources import texts, thml
from .synth import _ONES, _TENS, SAID, Views, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CHOSEN = ["Patristics", "Medieval", "Puritan", "Other", "Sermons"]
_IN = ", ".join(f"'{c}'" for c in CHOSEN)
#: Common pieces of the oracles.
_CATEGORY = "coalesce(nullif(category, ''), 'Other')"
_JOINED = "refs r JOIN works w ON w.id = r.manuscript_id"
_BASE = f"""base AS (SELECT book_slug, c.name AS book, c.book_order, chapter, count(*) AS n FROM {_JOINED} JOIN canon c ON c.slug = book_slug
  WHERE coalesce(category, 'Other') IN ({_IN}) AND chapter BETWEEN 1 AND c.chapters GROUP BY ALL)"""
_HEAT = "CASE WHEN {n} = 0 OR {m} = 0 THEN 0 WHEN {n} / {m} < 0.15 THEN 1 WHEN {n} / {m} < 0.40 THEN 2 WHEN {n} / {m} < 0.70 THEN 3 ELSE 4 END"
_LABEL = "CASE WHEN verse_start IS NULL THEN NULL WHEN verse_end IS NULL OR verse_end = verse_start THEN CAST(verse_start AS VARCHAR) ELSE verse_start || '-' || verse_end END"
_COUNTED = "counted AS (SELECT manuscript_id AS id, count(*) AS ref_count FROM refs GROUP BY 1)"
_WIDTH = "CASE WHEN max(year) - min(year) < 200 THEN 25 WHEN max(year) - min(year) < 500 THEN 50 WHEN max(year) - min(year) < 1000 THEN 100 WHEN max(year) - min(year) < 2000 THEN 200 ELSE 500 END"
_DATED = f"""picked AS (SELECT id, year FROM works WHERE year IS NOT NULL AND {_CATEGORY} IN ({_IN})),
  dated AS (SELECT id, year, CAST(year // width * width AS INT) AS bucket FROM picked, (SELECT {_WIDTH} AS width FROM picked))"""
_GRID = f"""{_DATED}, cells AS (SELECT book_slug, bucket, count(*) AS n FROM refs JOIN dated ON id = manuscript_id GROUP BY ALL),
  best AS (SELECT book_slug, book_order FROM cells JOIN canon ON slug = book_slug GROUP BY ALL ORDER BY sum(n) DESC, book_order LIMIT 20),
  grid AS (SELECT book_slug, book_order, bucket, n FROM cells JOIN best USING (book_slug))"""


def query(sql: str | None = None, extra: str = ""):
    """Registers a function of the views under its name, with its oracle; ``extra`` are further views of the SQL."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = oracle((", " + extra if extra else "") + sql)
        return f

    return register


def _found(v: Views) -> DataFrame:
    return citations.extract(v.citation_texts).select("id.*", "book", "book_slug", "chapter", "verse_start", "verse_end", "citation_offset")


@query(f"SELECT book_slug, chapter, coalesce(category, 'Other') AS category, count(*) AS n FROM said JOIN works ON id = manuscript_id GROUP BY ALL")
def citations_by_chapter_category(v: Views) -> DataFrame:
    return rollups.chapter_category_counts(_found(v), v.works)


@query("SELECT l_orderkey, l_linenumber, book_slug, chapter, verse_start, verse_end, CASE WHEN l_orderkey % 5 = 0 THEN 5 ELSE 3 END AS citation_offset FROM said")
def citation_roundtrip(v: Views) -> DataFrame:
    return _found(v).select("l_orderkey", "l_linenumber", "book_slug", "chapter", "verse_start", "verse_end", "citation_offset")


@query("SELECT book_slug, chapter, coalesce(category, 'Other') AS category, count(*) AS n FROM refs r JOIN works w ON w.id = r.manuscript_id GROUP BY ALL")
def chapter_category_counts(v: Views) -> DataFrame:
    return rollups.chapter_category_counts(v.refs, v.works)


@query(f"SELECT book_slug, chapter, count(*) AS n, count(DISTINCT coalesce(category, 'Other')) AS n_categories, count(*) FILTER (coalesce(category, 'Other') = 'Other') AS n_other FROM {_JOINED} GROUP BY ALL")
def chapter_totals(v: Views) -> DataFrame:
    t = rollups.chapter_totals(rollups.chapter_category_counts(v.refs, v.works))
    return t.select("book_slug", "chapter", "n", F.size("by_cat").cast("bigint").alias("n_categories"), F.coalesce(F.try_element_at("by_cat", F.lit("Other")), F.lit(0)).cast("bigint").alias("n_other"))


@query(f"SELECT book_slug, chapter, CAST(count(*) FILTER (coalesce(category, 'Other') IN ({_IN})) AS BIGINT) AS n FROM {_JOINED} GROUP BY ALL")
def filtered_counts(v: Views) -> DataFrame:
    t = rollups.chapter_totals(rollups.chapter_category_counts(v.refs, v.works))
    n = F.aggregate(F.map_values(F.map_filter("by_cat", lambda k, _: k.isin(CHOSEN))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return t.select("book_slug", "chapter", n.alias("n"))


@query("SELECT book_slug, c.name AS book, c.book_order, chapter, count(*) AS n FROM refs r JOIN works w ON w.id = r.manuscript_id JOIN canon c ON c.slug = book_slug WHERE chapter BETWEEN 1 AND c.chapters GROUP BY ALL")
def canon_bounds(v: Views) -> DataFrame:
    t = rollups.in_canon(rollups.chapter_category_counts(v.refs, v.works))
    return t.groupBy("book_slug", "book", "book_order", "chapter").agg(F.sum("n").alias("n"))


@query(f"SELECT id, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(nullif(title, ''), filename) AS title, year, ccel_url, {_CATEGORY} AS category, ref_count FROM works JOIN counted USING (id)", _COUNTED)
def works_ref_count(v: Views) -> DataFrame:
    return rollups.work_counts(v.refs, v.works)


@query("SELECT id, filename, coalesce(ref_count, 0) AS ref_count FROM works LEFT JOIN counted USING (id)", _COUNTED)
def reference_counts(v: Views) -> DataFrame:
    return rollups.reference_counts(v.refs, v.works)


@query("SELECT w.id, filename FROM works w LEFT JOIN refs r ON r.manuscript_id = w.id GROUP BY ALL HAVING count(r.manuscript_id) = 0")
def zero_ref_works(v: Views) -> DataFrame:
    return rollups.without_references(v.refs, v.works).select("id", "filename")


@query("SELECT DISTINCT 'manuscripts/' || filename AS path FROM works WHERE id IN (SELECT manuscript_id FROM refs)")
def referenced_files(v: Views) -> DataFrame:
    return rollups.referenced_files(v.refs, v.works)


@query(f"SELECT count(DISTINCT book_slug) AS files, count(*) AS refs FROM {_JOINED}")
def build_totals(v: Views) -> DataFrame:
    return rollups.build_totals(v.refs, v.works)


@query("SELECT (SELECT count(*) FROM works) AS works, (SELECT count(*) FROM refs) AS refs")
def table_counts(v: Views) -> DataFrame:
    return rollups.table_counts(v.refs, v.works)


@query("SELECT source_format, count(*) AS n FROM works GROUP BY ALL")
def format_counts(v: Views) -> DataFrame:
    return rollups.format_counts(v.works)


@query("SELECT category, count(*) AS n FROM works GROUP BY ALL")
def category_tally(v: Views) -> DataFrame:
    return rollups.category_tally(v.works)


@query("SELECT book, chapter, count(*) AS n FROM refs JOIN canon ON slug = book_slug GROUP BY book, chapter, book_order ORDER BY n DESC, book_order, chapter LIMIT 20")
def stats_top_chapters(v: Views) -> DataFrame:
    return rollups.top_chapters(v.refs)


@query("SELECT DISTINCT book_slug FROM refs")
def build_slugs(v: Views) -> DataFrame:
    return rollups.book_slugs(v.refs)


@query("SELECT book, chapter, n FROM base ORDER BY n DESC, book_order, chapter LIMIT 30", _BASE)
def top_chapters(v: Views) -> DataFrame:
    return explore.top_chapters(_base(v))


@query("SELECT book, CAST(sum(n) AS BIGINT) AS total FROM base GROUP BY book, book_order ORDER BY sum(n) DESC, book_order LIMIT 20", _BASE)
def top_books(v: Views) -> DataFrame:
    return explore.top_books(_base(v))


def _base(v: Views) -> DataFrame:
    return explore.filtered_chapters(v.refs, v.works, CHOSEN)


@query(f"SELECT (SELECT count(*) FROM {_JOINED} JOIN canon c ON c.slug = book_slug WHERE chapter BETWEEN 1 AND c.chapters) AS refs, (SELECT count(DISTINCT book_slug) FROM refs) AS books, (SELECT count(*) FROM counted) AS works", _COUNTED)
def welcome_stats(v: Views) -> DataFrame:
    return explore.welcome(v.refs, v.works)


@query("SELECT book_slug, book, book_order, CAST(sum(n) AS BIGINT) AS total, max(n) AS most FROM base WHERE contains(lower(book), 'an') GROUP BY ALL", _BASE)
def sidebar_books(v: Views) -> DataFrame:
    return explore.sidebar(_base(v), "AN")


@query(
    f"SELECT verse_key, n, {_HEAT.format(n='n', m='(max(n) OVER ())')} AS heat FROM keyed",
    f"keyed AS (SELECT coalesce(CAST(verse_start AS VARCHAR), 'whole') AS verse_key, count(*) AS n FROM {_JOINED} WHERE book_slug = 'psalms' AND chapter = 27 AND {_CATEGORY} IN ({_IN}) GROUP BY ALL)",
)
def verse_table(v: Views) -> DataFrame:
    return explore.verse_table(v.refs, v.works, "psalms", 27, CHOSEN)


@query("SELECT DISTINCT coalesce(nullif(author, ''), 'Unknown') AS author FROM works JOIN counted USING (id)", _COUNTED)
def author_facet(v: Views) -> DataFrame:
    return explore.author_facet(v.refs, v.works)


@query(f"SELECT DISTINCT {_CATEGORY} AS category FROM works")
def category_facet(v: Views) -> DataFrame:
    return explore.category_facet(v.works)


@query("SELECT book, min(book_slug) AS book_slug, min(chapter) AS chapter FROM refs WHERE manuscript_id = 5 GROUP BY book")
def book_facet(v: Views) -> DataFrame:
    return explore.book_facet(v.refs, 5)


@query(
    f"SELECT book_slug, total, {_HEAT.format(n='total', m='(greatest(1, max(total) OVER ()))')} AS heat FROM totals",
    f"{_BASE}, totals AS (SELECT slug AS book_slug, coalesce(CAST(sum(n) AS BIGINT), 0) AS total FROM canon LEFT JOIN base ON base.book_slug = slug GROUP BY slug)",
)
def coverage_heat(v: Views) -> DataFrame:
    return explore.coverage(_base(v))


@query(
    "SELECT category, n, CAST(floor(100 * n / sum(n) OVER () + 0.5) AS BIGINT) AS percent, CAST(sum(n) OVER (ORDER BY category) - n AS BIGINT) AS start FROM shares",
    f"shares AS (SELECT coalesce(category, 'Other') AS category, count(*) AS n FROM {_JOINED} GROUP BY 1)",
)
def category_share(v: Views) -> DataFrame:
    return explore.category_share(rollups.chapter_category_counts(v.refs, v.works))


@query("SELECT manuscript_id, book_group, count(*) AS n FROM refs JOIN canon ON slug = book_slug GROUP BY ALL")
def book_group_counts(v: Views) -> DataFrame:
    return explore.group_counts(v.refs)


@query("SELECT id, year, bucket FROM dated", _DATED)
def work_buckets(v: Views) -> DataFrame:
    return explore.dated(v.works, CHOSEN).select("id", "year", "bucket")


@query(
    "SELECT bucket, book_group, n, CAST(floor(n / sum(n) OVER (PARTITION BY bucket) * 10000 + 0.5) AS BIGINT) AS share, CAST(floor((sum(n) OVER (PARTITION BY bucket ORDER BY group_order) - n) / sum(n) OVER (PARTITION BY bucket) * 10000 + 0.5) AS BIGINT) AS start FROM g",
    f"{_DATED}, g AS (SELECT bucket, book_group, group_order, count(*) AS n FROM refs JOIN dated ON id = manuscript_id JOIN canon ON slug = book_slug GROUP BY ALL)",
)
def bucket_share(v: Views) -> DataFrame:
    whole = lambda c: F.floor(F.col(c) * 10000 + 0.5).cast("bigint").alias(c)
    return explore.bucket_shares(v.refs, v.works, CHOSEN).select("bucket", "book_group", "n", whole("share"), whole("start"))


@query("SELECT book_slug, book_order, bucket, n FROM grid", _GRID)
def wormtrail_grid(v: Views) -> DataFrame:
    return explore.book_grid(v.refs, v.works, CHOSEN)


@query(
    "SELECT book_slug, bucket, n, round(200 - total * scale / 2 + before * scale, 6) AS top, round(200 - total * scale / 2 + before * scale + n * scale, 6) AS bottom FROM laid",
    f"{_GRID}, stacked AS (SELECT *, sum(n) OVER (PARTITION BY bucket) AS total, sum(n) OVER (PARTITION BY bucket ORDER BY book_order) - n AS before FROM grid), laid AS (SELECT *, 400.0::DOUBLE / max(total) OVER () AS scale FROM stacked)",
)
def stream_layout(v: Views) -> DataFrame:
    at = lambda c: F.round(c, 6).alias(c)
    return explore.stream_layout(explore.book_grid(v.refs, v.works, CHOSEN)).select("book_slug", "bucket", "n", at("top"), at("bottom"))


@query("SELECT book_slug, bucket, n FROM grid QUALIFY row_number() OVER (PARTITION BY book_slug ORDER BY n DESC, bucket) = 1", _GRID)
def widest_bucket(v: Views) -> DataFrame:
    return explore.widest_bucket(explore.book_grid(v.refs, v.works, CHOSEN))


@query(
    f"SELECT id, year, ref_count, (SELECT count(*) FROM works JOIN counted USING (id) WHERE year IS NULL AND {_CATEGORY} IN ({_IN})) AS undated FROM works JOIN counted USING (id) WHERE year IS NOT NULL AND {_CATEGORY} IN ({_IN})",
    _COUNTED,
)
def works_timeline(v: Views) -> DataFrame:
    return explore.timeline(v.refs, v.works, CHOSEN)


@query("SELECT book_slug, min(chapter) AS chapter FROM base GROUP BY book_slug", _BASE)
def first_chapters(v: Views) -> DataFrame:
    return explore.first_chapter(_base(v))


@query(f"SELECT manuscript_id AS w, {_LABEL} AS v, coalesce(author, '') AS author FROM {_JOINED} WHERE book_slug = 'genesis' AND chapter = 3 AND {_CATEGORY} IN ({_IN})")
def chapter_listing(v: Views) -> DataFrame:
    return explore.chapter_listing(v.refs, v.works, None, "genesis", 3, categories=CHOSEN).select("w", "v", F.coalesce("author", F.lit("")).alias("author"))


@query(f"SELECT manuscript_id AS w, {_LABEL} AS v FROM {_JOINED} WHERE book_slug = 'romans' AND verse_start = 13 AND chapter = 8")
def verse_drilldown(v: Views) -> DataFrame:
    return explore.chapter_listing(v.refs, v.works, None, "romans", 8, verse="13").select("w", "v")


@query(f"SELECT book_slug, book || ' ' || chapter || coalesce(':' || {_LABEL}, '') AS place FROM {_JOINED} WHERE manuscript_id = 7")
def work_listing(v: Views) -> DataFrame:
    return explore.work_listing(v.refs, v.works, 7).select("book_slug", "place")


@query("SELECT id, author, title FROM (SELECT id, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(nullif(title, ''), filename) AS title FROM works JOIN counted USING (id)) WHERE contains(lower(author || ' ' || title), 'author 1')", _COUNTED)
def search_works(v: Views) -> DataFrame:
    return explore.search_works(v.refs, v.works, "Author 1").select("id", "author", "title")


@query(f"SELECT DISTINCT verse_start, verse_end, {_LABEL} AS v, coalesce(CAST(verse_start AS VARCHAR), 'whole') AS verse_key FROM refs")
def verse_labels(v: Views) -> DataFrame:
    label = S.verse_label(F.col("verse_start"), F.col("verse_end"))
    return v.refs.select("verse_start", "verse_end").distinct().select("verse_start", "verse_end", label.alias("v"), S.verse_key(label).alias("verse_key"))


@query("SELECT DISTINCT filename, passage_start_offset, passage_end_offset, regexp_replace(filename, '\\.txt$', '') || '_' || passage_start_offset || '_' || passage_end_offset AS p FROM refs JOIN works ON id = manuscript_id")
def passages_distinct(v: Views) -> DataFrame:
    spans = rollups.labelled(v.refs, v.works).select("filename", "passage_start_offset", "passage_end_offset", "p").distinct()
    return spans


@query(f"SELECT book_slug, book, chapter, count(*) AS n_refs, count({_LABEL}) AS n_labels, sha256(string_agg(coalesce({_LABEL}, '-') || '/' || manuscript_id, ',' ORDER BY coalesce(verse_start, 2147483647), coalesce(author, ''), coalesce(title, ''), coalesce({_LABEL}, '') , manuscript_id)) AS listed FROM {_JOINED} GROUP BY ALL")
def book_payload_flat(v: Views) -> DataFrame:
    rows = rollups.book_payloads(v.refs, v.works).select("book_slug", "book", F.explode("chapters").alias("c"))
    told = F.array_join(F.transform("c.refs", lambda r: F.concat(F.coalesce(r["v"], F.lit("-")), F.lit("/"), r["w"].cast("string"))), ",")
    return rows.select("book_slug", "book", F.col("c.ch").alias("chapter"), F.size("c.refs").cast("bigint").alias("n_refs"), F.size(F.filter("c.refs", lambda r: r["v"].isNotNull())).cast("bigint").alias("n_labels"), F.sha2(told.cast("binary"), 256).alias("listed"))


@query(f"SELECT w.id, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(nullif(title, ''), filename) AS title, year, ccel_url, count(*) AS n_refs, min(book_slug) AS first_book FROM {_JOINED} GROUP BY ALL")
def work_payload_flat(v: Views) -> DataFrame:
    return rollups.work_payloads(v.refs, v.works).select("id", "author", "title", "year", "ccel_url", F.size("refs").cast("bigint").alias("n_refs"), F.col("refs")[0]["book_slug"].alias("first_book"))


@query(f"SELECT (SELECT count(DISTINCT book_slug) FROM refs) AS n_books, (SELECT count(*) FROM counted) AS n_works", _COUNTED)
def index_payload(v: Views) -> DataFrame:
    p = rollups.index_payload(v.refs, v.works)
    return p.select(F.size("books").cast("bigint").alias("n_books"), F.size("works").cast("bigint").alias("n_works"))


@query("""SELECT l_orderkey, l_linenumber, c.slug AS book_slug, CAST(l_orderkey % 7 + 1 AS INT) AS chapter,
  CASE WHEN f = 3 THEN NULL ELSE CAST(l_quantity AS INT) END AS verse_start, CASE WHEN f <> 3 AND l_linenumber % 3 > 0 THEN CAST(l_quantity AS INT) + l_linenumber % 3 END AS verse_end
FROM (SELECT *, (l_orderkey + l_linenumber) % 8 AS f FROM lineitem) JOIN canon c ON c.book_order = l_partkey % 82 + 1 WHERE f >= 3""")
def parsed_attr_decode(v: Views) -> DataFrame:
    return citations.decode_attribute(v.attributes).select("l_orderkey", "l_linenumber", "book_slug", "chapter", "verse_start", "verse_end")


@query(f"SELECT o_orderkey, n, repeat('c', CAST(n // 100 AS INT)) || ({_TENS})[n // 10 % 10 + 1] || ({_ONES})[n % 10 + 1] AS roman, n AS back FROM (SELECT o_orderkey, CAST(o_orderkey % 299 + 1 AS INT) AS n FROM orders)")
def roman_numerals(v: Views) -> DataFrame:
    n = v.raw("orders").select("o_orderkey", (F.col("o_orderkey") % 299 + 1).cast("int").alias("n"))
    told = n.select("o_orderkey", "n", int_to_roman(F.col("n")).alias("roman"))
    return told.select("o_orderkey", "n", "roman", roman_to_int(F.upper("roman")).alias("back"))


@query("SELECT w.id, CAST(coalesce(y.year, w.year) AS INT) AS year FROM works w LEFT JOIN years y USING (filename)")
def year_update(v: Views) -> DataFrame:
    return store.update_years(v.works, v.years).select("id", "year")


@query("SELECT filename FROM years WHERE filename NOT IN (SELECT filename FROM works)")
def year_update_missing(v: Views) -> DataFrame:
    return store.unmatched_years(v.works, v.years)


@query("SELECT count(*) FILTER (filename IN (SELECT filename FROM works)) AS updated, count(*) FILTER (filename NOT IN (SELECT filename FROM works)) AS not_found FROM years")
def year_update_tally(v: Views) -> DataFrame:
    return store.year_tally(v.works, v.years)


@query("SELECT o.id, o.year AS old_year, w.year AS new_year FROM outputs o JOIN works w USING (id) WHERE w.year IS NOT NULL AND o.year IS DISTINCT FROM w.year")
def patch_changed(v: Views) -> DataFrame:
    return store.patches(v.outputs, v.works)


@query("SELECT id, source_format FROM works w WHERE source_format = 'thml' OR ccel_url IS NULL OR NOT EXISTS (SELECT 1 FROM works t WHERE t.source_format = 'thml' AND t.ccel_url = w.ccel_url)")
def thml_precedence(v: Views) -> DataFrame:
    return store.annotated_first(v.works).select("id", "source_format")


_DELETE, _PURGE = [f"w{i}.txt" for i in (1, 4, 8)], [f"w{i}.txt" for i in (2, 6, 9)]


@query("""SELECT id, CASE WHEN id % 10 = 3 OR id IN (2, 6, 9) THEN 'archived' ELSE 'kept' END AS state FROM works WHERE id NOT IN (1, 4, 8)""")
def purge_then_archive(v: Views) -> DataFrame:
    works, _, archived = store.clean(v.works, v.refs, _DELETE, _PURGE)
    return works.select("id", F.lit("kept").alias("state")).unionByName(archived.select("id", F.lit("archived").alias("state")))


@query("SELECT manuscript_id, count(*) AS n FROM refs WHERE manuscript_id % 6 <> 0 GROUP BY 1 UNION ALL SELECT manuscript_id, 1 FROM (SELECT DISTINCT manuscript_id FROM refs WHERE manuscript_id % 12 = 0)")
def reparse_replaces(v: Views) -> DataFrame:
    again = v.works.where("id % 6 = 0")
    new = v.refs.where("manuscript_id % 12 = 0").dropDuplicates(["manuscript_id"])
    return store.replace_references(v.refs, again, new).groupBy("manuscript_id").agg(F.count("*").alias("n"))


@query("SELECT id, filename, CASE WHEN id % 4 = 0 THEN 'New' ELSE title END AS title FROM works UNION ALL SELECT max(id) + 1, 'zz1.txt', 'Z1' FROM works UNION ALL SELECT max(id) + 2, 'zz2.txt', 'Z2' FROM works")
def upsert_works(v: Views) -> DataFrame:
    extra = v.spark.createDataFrame([("zz2.txt", "Z2"), ("zz1.txt", "Z1")], "filename string, title string")
    new = v.works.where("id % 4 = 0").withColumn("title", F.lit("New")).unionByName(extra, allowMissingColumns=True)
    return store.upsert(v.works, new).select("id", "filename", "title")


_SUBJECTS = "CASE id % 5 WHEN 0 THEN 'early' WHEN 1 THEN 'history' WHEN 2 THEN 'mysticism' WHEN 3 THEN 'all' ELSE NULL END"
_TITLES = "CASE id % 8 WHEN 0 THEN 'A Commentary on X' WHEN 1 THEN 'Sermons' WHEN 2 THEN 'Small Catechism' WHEN 3 THEN 'Systematic Theology' WHEN 4 THEN 'Institutes' WHEN 5 THEN 'Hymns' WHEN 6 THEN 'In Defence of Y' ELSE NULL END"
_AUTHORS = "CASE id % 7 WHEN 0 THEN 'John Owen' WHEN 1 THEN 'C. H. Spurgeon' WHEN 2 THEN 'Blaise Pascal' WHEN 3 THEN 'Andrew Murray' WHEN 4 THEN 'John Calvin' ELSE NULL END"
_CLASSED = f"classed AS (SELECT id, filename, {_AUTHORS} AS author, {_TITLES} AS title, year, {_SUBJECTS} AS subject FROM works)"
_RULES_SQL = """CASE WHEN title LIKE '%Commentary%' THEN 'Biblical Commentary' WHEN title LIKE '%Catechism%' THEN 'Scripture' WHEN subject = 'early' OR year < 600 THEN 'Patristics'
  WHEN subject = 'mysticism' OR year BETWEEN 600 AND 1499 THEN 'Medieval' WHEN title = 'Systematic Theology' THEN 'Systematic Theology' WHEN subject = 'history' THEN 'Church History'
  WHEN author = 'John Calvin' OR title = 'Institutes' THEN 'Reformation' WHEN author = 'John Owen' THEN 'Puritan' WHEN author = 'C. H. Spurgeon' OR title = 'Sermons' THEN 'Sermons'
  WHEN author = 'Blaise Pascal' OR title = 'In Defence of Y' THEN 'Apologetics' WHEN author = 'Andrew Murray' OR title = 'Hymns' THEN 'Devotional' ELSE 'Other' END"""


@query(f"SELECT id, {_RULES_SQL} AS category FROM classed", _CLASSED)
def classify_works(v: Views) -> DataFrame:
    works = v.works.selectExpr("id", "filename", f"{_AUTHORS} AS author", f"{_TITLES} AS title", "year", "category", f"{_SUBJECTS} AS subject")
    subjects = works.select("filename", F.when(F.col("subject").isNotNull(), F.array("subject")).alias("subjects"))
    return classify.categorise(works.drop("subject"), subjects).select("id", "category")


@query(r"""SELECT page_id, count(*) AS n_links, count(DISTINCT href) AS n_hrefs FROM (
  SELECT page_id, regexp_extract(unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>')), '(?is)href\s*=\s*["'']([^"'']*)', 1) AS href FROM pages) GROUP BY page_id""")
def page_links(v: Views) -> DataFrame:
    return texts.links(v.raw("pages")).groupBy("page_id").agg(F.count("*").alias("n_links"), F.count_distinct("href").alias("n_hrefs"))


_STATUS = "CASE event_type WHEN 'click' THEN 'downloaded' WHEN 'view' THEN 'cached' ELSE 'failed' END"


@query(f"SELECT count(*) FILTER ({_STATUS} = 'downloaded') AS downloaded, count(*) FILTER ({_STATUS} = 'cached') AS cached, count(*) FILTER ({_STATUS} = 'failed') AS failed FROM events")
def manifest_summary(v: Views) -> DataFrame:
    return texts.manifest_summary(v.raw("events").selectExpr(f"{_STATUS} AS status"))


@query("SELECT user_id % 50 AS author_id, CAST(max(event_id) AS BIGINT) AS event_id FROM events WHERE user_id % 50 >= 10 GROUP BY 1 UNION ALL SELECT user_id % 50, -1 FROM events WHERE user_id % 50 < 10 GROUP BY 1")
def manifest_merge(v: Views) -> DataFrame:
    old = v.raw("events").groupBy((F.col("user_id") % 50).alias("author_id")).agg(F.max("event_id").alias("event_id")).withColumn("book_id", F.lit("b"))
    new = old.where("author_id < 10").withColumn("event_id", F.lit(-1).cast("bigint"))
    return texts.merged_manifest(old, new).select("author_id", "event_id")


def _passage_works(v: Views) -> DataFrame:
    """Documents as texts of paragraphs, each with citations behind it; all citation texts are dealt over the documents by number."""
    docs = v.raw("documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    many = F.broadcast(docs.agg(F.count("*").alias("documents")))
    key = F.col("id.l_orderkey")
    said = v.citation_texts.crossJoin(many).groupBy((key % F.col("documents")).alias("slot")).agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda x: x["text"]).alias("said"))
    placed = docs.crossJoin(many).withColumn("slot", F.col("doc_id") % F.col("documents"))
    rows = placed.join(said, "slot", "left").withColumn("parts", F.split("text", "\n", -1)).withColumn("said", F.coalesce("said", F.array().cast("array<string>")))
    # Citations go round the paragraphs, or paragraphs round the citations, until each has met one.
    last, step = F.greatest(F.size("parts"), F.size("said")) - 1, F.size("parts")
    behind = lambda i: F.array_join(F.transform(F.sequence(i, last, step), lambda j: F.get(F.col("said"), j % F.size("said"))), " ")
    cited = F.transform("parts", lambda x, i: F.when(F.size("said") > 0, F.concat(x, F.lit(" "), behind(i))).otherwise(x))
    return rows.select(F.col("doc_id").alias("id"), F.array_join(cited, "\n\n").alias("text"))


@query()
def passage_windows(v: Views) -> DataFrame:
    return windows.cited(_passage_works(v))


@query()
def passage_texts(v: Views) -> DataFrame:
    rows = _passage_works(v)
    found = windows.cited(rows).withColumnRenamed("id", "manuscript_id")
    works = rows.select("id", F.concat(F.lit("d"), F.col("id").cast("string"), F.lit(".txt")).alias("filename"))
    return windows.passages(found, works, rows.select(F.concat(F.lit("d"), F.col("id").cast("string"), F.lit(".txt")).alias("filename"), "text"))


@query("""SELECT l_orderkey, l_linenumber, manuscript_id, o AS citation_offset, 0 AS passage_start_offset, CAST(30 + length(text) AS INT) AS passage_end_offset
FROM (SELECT *, unnest([30 + citation_offset, CAST(39 + length(text) + citation_offset AS INT)]) AS o FROM cited)""")
def footnote_hop(v: Views) -> DataFrame:
    body = F.concat(F.lit("Some words here [1] and more. "), F.col("text"), F.lit("\n\n   [1] "), F.col("text"))
    rows = v.citation_texts.select("id", body.alias("text"))
    return windows.cited(rows).select("id.*", "citation_offset", "passage_start_offset", "passage_end_offset")


def _wrapped(v: Views) -> DataFrame:
    """(id, text) of each citation in a sentence of a paragraph of up to 27, between two others."""
    # The first n of sentences that are all as long as each other.
    many = lambda n, text: F.substring(F.lit("".join(text.format(f"{i:02d}") for i in range(15))), F.lit(1), F.greatest(n, F.lit(0)).cast("int") * len(text.format("00")))
    a, b = F.col("id.l_orderkey") % 15, (F.col("id.l_orderkey") + F.col("id.l_linenumber") * 4) % 13
    citing = F.concat(F.lit(_CITING.split("{}")[0]), F.col("text"), F.lit(_CITING.split("{}")[1]))
    body = F.concat(F.lit("Head.\n \n"), many(a, _BEFORE), citing, many(b, _BEHIND), F.lit("\n\nLast part."))
    return v.citation_texts.select("id", body.alias("text"))


#: Sentences before and behind the citing one, which a joined break and a short sentence make harder; all have lengths that SQL can sum.
_BEFORE, _BEHIND, _CITING = "Words of line {} go. ", " After {} it is.", "Dr. Zzed cites {} here. Ok."


@query(
    f"""SELECT l_orderkey, l_linenumber, manuscript_id, CAST(8 + 21 * a + 15 + citation_offset AS INT) AS citation_offset, CAST(8 + low AS INT) AS passage_start_offset, CAST(8 + high AS INT) AS passage_end_offset,
  substr(body, CAST(low + 1 AS INT), CAST(high - low AS INT)) AS passage FROM (
  SELECT *, CASE WHEN first <= a THEN 21 * first ELSE 21 * a + size + 1 + 16 * (first - a - 1) END AS low,
    CASE WHEN last < a THEN 21 * last + 20 WHEN last = a THEN 21 * a + size ELSE 21 * a + size + 16 * (last - a) END AS high FROM (
    SELECT *, CASE WHEN n <= 10 THEN 0 ELSE least(greatest(a - 5, 0), n - 10) END AS first, CASE WHEN n <= 10 THEN n - 1 ELSE least(greatest(a - 5, 0), n - 10) + 9 END AS last FROM laid))""",
    """laid AS (SELECT *, a + 1 + b AS n, length(text) + 25 AS size,
    coalesce(list_aggregate(list_transform(range(a), lambda i: 'Words of line ' || lpad(CAST(i AS VARCHAR), 2, '0') || ' go. '), 'string_agg', ''), '') || 'Dr. Zzed cites ' || text || ' here. Ok.'
      || coalesce(list_aggregate(list_transform(range(b), lambda i: ' After ' || lpad(CAST(i AS VARCHAR), 2, '0') || ' it is.'), 'string_agg', ''), '') AS body
  FROM (SELECT *, l_orderkey % 15 AS a, (l_orderkey + l_linenumber * 4) % 13 AS b FROM cited))""",
)
def sentence_windows(v: Views) -> DataFrame:
    """Windows of ten sentences in a paragraph of up to 27, between two others, and their texts."""
    rows = _wrapped(v)
    found = windows.cited(rows.select(F.struct("id", "text").alias("id"), "text"))
    made = windows.passage_text(F.col("id.text"), F.col("passage_start_offset"), F.col("passage_end_offset"), F.lit("x"))
    return found.select("id.id.*", "citation_offset", "passage_start_offset", "passage_end_offset", made.alias("passage"))


_SEGMENTS = """segments AS (SELECT parsed, string_split(trim(s), '|') AS p, path FROM (SELECT 'a/' || l_orderkey || '.xml' AS path, parsed, unnest(string_split(parsed, ';')) AS s FROM attributes)),
  decoded AS (SELECT path, parsed, c.name AS book, c.slug AS book_slug, TRY_CAST(p[3] AS INT) AS chapter, TRY_CAST(p[4] AS INT) AS vs, TRY_CAST(p[6] AS INT) AS ve FROM segments JOIN canon c ON len(p) = 6 AND lower(trim(p[2])) IN (lower(c.name), c.slug))"""


@query("SELECT path, parsed, CAST(13 AS INT) AS citation_offset, book, book_slug, chapter, CASE WHEN vs > 0 THEN vs END AS verse_start, CASE WHEN ve > 0 AND ve <> vs THEN ve END AS verse_end FROM decoded WHERE chapter >= 1 AND vs IS NOT NULL AND ve IS NOT NULL", _SEGMENTS)
def thml_walk(v: Views) -> DataFrame:
    xml = F.concat(
        F.lit("<?xml version='1.0'?><ThML><ThML.head><DC.Title>T</DC.Title><DC.Creator sub='Author'>Last, First (1-2)</DC.Creator><DC.Date sub='Published'>1650</DC.Date></ThML.head><body><p>Words &amp; <note>skipped</note>tail "),
        F.lit("<scripRef parsed=\""), F.col("parsed"), F.lit("\">here</scripRef> end.</p></body></ThML>"),
    )
    docs = v.attributes.select(F.concat(F.lit("a/"), F.col("l_orderkey").cast("string"), F.lit(".xml")).alias("path"), xml.alias("content"))
    hits = thml.parse(docs).select("path", F.explode("hits").alias("h")).select("path", "h.*")
    return citations.decode_attribute(hits)


@query("""SELECT 'x/a' || doc_id % 7 || '/b' || doc_id || '.xml' AS path, 'x/a' || doc_id % 7 || '/b' || doc_id || '.txt' AS filename, coalesce(text, '') || ' see Rom!' AS clean_text, CAST(length(coalesce(text, '')) + 5 AS INT) AS citation_offset,
  'First Last' AS author, 'On ' || doc_id AS title, CAST(CASE WHEN doc_id % 3 = 0 THEN 1650 ELSE 1700 END AS INT) AS year, 'https://site.example/a' || doc_id % 7 || '/' || CASE WHEN doc_id % 2 = 0 THEN 'own' || doc_id ELSE 'b' || doc_id END AS ccel_url FROM documents""")
def thml_documents(v: Views) -> DataFrame:
    """Whole documents as annotated XML: clean text, place of the annotation, metadata."""
    number, text = F.col("doc_id").cast("string"), S.escaped(F.col("text"))
    book = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<bookID>own"), number, F.lit("</bookID>"))).otherwise(F.lit("<bookID/>"))
    sub = F.when(F.col("doc_id") % 3 == 0, F.lit("Published")).otherwise(F.lit("Digitised"))
    xml = F.concat(
        F.lit("<ThML><ThML.head><!-- c --><DC.Title>On "), number, F.lit("</DC.Title><DC.Creator>Last, First (1-2)</DC.Creator><DC.Date sub='Scanned'>c. 1700</DC.Date><DC.Date sub='"), sub, F.lit("'>1650</DC.Date>"), book,
        F.lit("</ThML.head><ThML.body><p>"), text, F.lit("<note>skip &lt;this</note> see <scripRef parsed=\"|Romans|8|13|8|17\">Rom</scripRef>!<pb n='2'/></p></ThML.body></ThML>"),
    )
    docs = v.dealt("documents").select(F.concat(F.lit("x/a"), (F.col("doc_id") % 7).cast("string"), F.lit("/b"), number, F.lit(".xml")).alias("path"), xml.alias("content"))
    parsed = thml.parse(docs)
    return thml.works(parsed.withColumn("citation_offset", F.col("hits")[0]["citation_offset"]), "https://site.example", keep=("clean_text", "citation_offset")).drop("category", "source_format")


@query("SELECT l_orderkey, l_linenumber, manuscript_id, CASE WHEN verse_start IS NULL THEN text ELSE '<mark>' || text || '</mark>' END AS marked FROM cited")
def highlighted(v: Views) -> DataFrame:
    return _highlighted(v, F.col("text"))


@query("SELECT l_orderkey, l_linenumber, manuscript_id, 'Not &lt;this&gt;. ' || CASE WHEN verse_start IS NULL THEN 'He says ' || text || ' so!' ELSE '<mark>He says ' || text || ' so!</mark>' END || '&quot; Then &amp; more.' AS marked FROM cited")
def highlighted_sentences(v: Views) -> DataFrame:
    return _highlighted(v, F.concat(F.lit("Not <this>. He says "), F.col("text"), F.lit(' so!" Then & more.')))


def _highlighted(v: Views, text: Column) -> DataFrame:
    # The text travels with its key, so nothing is joined back.
    texts_ = v.citation_texts.withColumn("text", text)
    rows = citations.extract(texts_.select(F.struct("id", "text").alias("id"), "text")).select("id.*", "chapter", "verse_start", "verse_end")
    key = S.verse_key(S.verse_label(F.col("verse_start"), F.col("verse_end")))
    return rows.select("id.*", highlight.highlight_passage(F.col("text"), F.col("chapter"), key).alias("marked"))


def _citation_sql(source: str = "documents") -> str:
    """The extraction over (doc_id, text) of a table: characters beyond ASCII become one letter or one sign each, so that word bounds are ASCII's."""
    known = abbreviations()
    book = "|".join(re.escape(k).replace("\\ ", " ") for k in known)
    p = rf"(?i)\b((?:(?:saint|st\.?)\s+)?(?:{book}))\b(?:[\s.:]+([ivxlcdm]+|\d+)(?:[\s.:]+(\d+(?:\s*[-–]\s*\d+)?(?:\s*,\s*\d+)*))?)?"
    rows = ", ".join(f"('{k}', '{b.slug}', '{b.name}', {b.chapters})" for k, b in known.items())
    digit = "list_transform(string_split(upper(ch), ''), lambda x: CASE x WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 ELSE 1000 END)"
    return rf"""plain AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\p{{Z}}', ' ', 'g'), '[^\x00-\x7F\P{{L}}]', 'q', 'g'), '[^\x00-\x7F–]', '~', 'g') AS t FROM {source}),
  hits AS (SELECT doc_id, unnest(regexp_extract_all(t, '{p}')) AS hit, unnest(string_split(regexp_replace(t, '{p}', chr(1), 'g'), chr(1))) AS gap, generate_subscripts(string_split(regexp_replace(t, '{p}', chr(1), 'g'), chr(1)), 1) AS i FROM plain),
  placed AS (SELECT doc_id, hit, sum(length(gap) + length(coalesce(hit, ''))) OVER (PARTITION BY doc_id ORDER BY i) - length(coalesce(hit, '')) AS place FROM hits),
  parts AS (SELECT doc_id, place, regexp_extract(hit, '{p}', 1) AS raw, regexp_extract(hit, '{p}', 2) AS ch, regexp_extract_all(regexp_extract(hit, '{p}', 3), '\d+') AS vs FROM placed WHERE hit IS NOT NULL),
  told AS (SELECT *, trim(regexp_replace(replace(regexp_replace(lower(raw), '\bst(?:\.?\s+|aint\s+)', '', 'g'), '.', ''), '\s+', ' ', 'g')) AS k, {digit} AS d FROM parts WHERE ch <> ''),
  numbered AS (SELECT *, CASE WHEN regexp_full_match(ch, '\d+') THEN TRY_CAST(ch AS INT) ELSE CAST(list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN i < len(d) AND d[i] < d[i + 1] THEN -d[i] ELSE d[i] END)) AS INT) END AS chapter FROM told),
  spelled AS (SELECT * FROM (VALUES {rows}) AS t(k, book_slug, book, chapters))"""


@query(
    "SELECT doc_id, book, book_slug, chapter, TRY_CAST(vs[1] AS INT) AS verse_start, CASE WHEN TRY_CAST(vs[len(vs)] AS INT) <> TRY_CAST(vs[1] AS INT) THEN TRY_CAST(vs[len(vs)] AS INT) END AS verse_end, CAST(place AS INT) AS citation_offset FROM numbered JOIN spelled USING (k) WHERE chapter BETWEEN 1 AND chapters",
    _citation_sql(),
)
def document_citations(v: Views) -> DataFrame:
    """Citations, all of them chance hits, in the raw documents."""
    return citations.extract(v.dealt("documents"), key="doc_id")


@query("SELECT name AS book, slug AS book_slug, book_order, chapters, book_group, count(manuscript_id) AS n FROM canon LEFT JOIN refs ON book_slug = slug GROUP BY ALL")
def book_dimension(v: Views) -> DataFrame:
    """All books, with how often they are cited."""
    n = v.refs.groupBy("book_slug").agg(F.count("*").alias("n"))
    books = canon(v.spark).select(F.col("name").alias("book"), F.col("slug").alias("book_slug"), "book_order", "chapters", "book_group")
    return books.join(n, "book_slug", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


@query("SELECT doc_id, replace(left(text, 80), chr(10), ' ') AS preview, CASE WHEN length(text) > 140 THEN left(text, 139) || '…' ELSE text END AS short, replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM documents")
def text_previews(v: Views) -> DataFrame:
    """Previews and shortened texts, which are what a list shows of a text, and the whole texts as they are written into a page."""
    text = F.col("text")
    return v.raw("documents").select("doc_id", S.preview(text).alias("preview"), S.shortened(text, 140).alias("short"), S.escaped(text).alias("escaped"))


@query("SELECT doc_id, replace(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM documents")
def text_escaped(v: Views) -> DataFrame:
    """Whole texts."""
    return v.raw("documents").select("doc_id", S.escaped(F.col("text")).alias("escaped"))


@query("""SELECT id, 'F' || id || ' L' || id AS author, title, year, CASE WHEN id % 3 = 0 THEN 'early,history' ELSE '' END AS subjects FROM (
  SELECT id, coalesce(title, 'No title') AS title, CASE WHEN year >= 1000 THEN year END AS year FROM works)""")
def header_fields(v: Views) -> DataFrame:
    rule, line = F.lit("_" * 30 + "\n"), F.lit("\n")
    number = F.col("id").cast("string")
    subjects = F.when(F.col("id") % 3 == 0, F.lit("   CCEL Subjects: Early; History;\n")).otherwise(F.lit(""))
    text = F.concat(
        F.lit("x\n"), rule, F.lit("  Title: "), F.coalesce("title", F.lit("No title")), line, F.lit("Creator(s): L"), number, F.lit(", Dr. F"), number, F.lit(" (1600-1650)\n"),
        F.lit("Print Basis: London, "), F.coalesce(F.col("year").cast("string"), F.lit("n.d.")), line, subjects, rule, F.lit("body 1234\n"),
    )
    head = S.header(F.col("text"))
    rows = v.works.select("id", text.alias("text"))
    return rows.select("id", S.header_author(head).alias("author"), S.field(head, "Title").alias("title"), S.header_year(head).alias("year"), F.array_join(S.subjects(head), ",").alias("subjects"))


@query("""SELECT l_orderkey, l_linenumber, span, CAST(CASE WHEN span / mag BETWEEN 2 AND 8 THEN mag WHEN span / (2 * mag) BETWEEN 2 AND 8 THEN 2 * mag WHEN span / (5 * mag) BETWEEN 2 AND 8 THEN 5 * mag ELSE 10 * mag END AS BIGINT) AS step
FROM (SELECT *, pow(10, floor(log10(span / 5.0))) AS mag FROM (SELECT l_orderkey, l_linenumber, 10 + (l_orderkey * 7 + l_partkey) % 3000 AS span FROM lineitem))""")
def tick_steps(v: Views) -> DataFrame:
    rows = v.raw("lineitem").select("l_orderkey", "l_linenumber", (10 + (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 3000).alias("span"))
    return rows.withColumn("step", S.tick_step(F.col("span").cast("double")).cast("bigint"))


#: A dictionary of the cited verses, but every third, in one document a book.
_VERSES = "verses AS (SELECT DISTINCT book_slug AS slug, chapter, verse_start AS verse, book || ' ' || chapter || ':' || verse_start AS text FROM refs WHERE (chapter + verse_start) % 3 > 0)"


@query("SELECT slug, chapter, verse, text FROM verses", _VERSES)
def verse_dictionary(v: Views) -> DataFrame:
    """The dictionary's rows, written for joins and read again."""
    text = F.concat(F.lit(" "), "book", F.lit(" "), F.col("chapter").cast("string"), F.lit(":"), F.col("verse_start").cast("string"))
    cited = v.refs.where("(chapter + verse_start) % 3 > 0").select("book", F.col("chapter").cast("string").alias("chapter"), F.struct(F.col("verse_start").cast("string").alias("verse"), text.alias("text")).alias("v")).distinct()
    chapters = cited.groupBy("book", "chapter").agg(F.collect_list("v").alias("verses")).groupBy("book").agg(F.collect_list(F.struct("chapter", "verses")).alias("chapters"))
    path = f"{shared_dir(v.spark).rstrip('/')}/verses-{uuid.uuid4().hex}"
    texts.write_verses(texts.verse_texts(chapters.select(F.to_json(F.struct("book", "chapters")).alias("value"))), path)
    return texts.read_verses(v.spark, path)


@query(f"SELECT l_orderkey, l_linenumber, rpad(label, CAST(greatest(30, length(label)) AS INT), ' ') AS label FROM (SELECT l_orderkey, l_linenumber, book || ' ' || chapter || CASE WHEN verse_start > 0 THEN ':' || verse_start || CASE WHEN verse_end > 0 THEN '-' || verse_end ELSE '' END ELSE '' END AS label FROM said)")
def reference_labels(v: Views) -> DataFrame:
    said = v.spark.sql(SAID, lineitem=v.raw("lineitem"), canon=v.canon)
    return said.select("l_orderkey", "l_linenumber", S.reference_label(F.col("book"), F.col("chapter"), F.col("verse_start"), F.col("verse_end")).alias("label"))


_WITH_TEXT = f"FROM (SELECT *, {_LABEL} AS v FROM refs) LEFT JOIN verses t ON t.slug = book_slug AND t.chapter = ref_chapter AND t.verse = verse_start".replace("SELECT *,", "SELECT *, chapter AS ref_chapter,")


@query(f"SELECT book_slug, ref_chapter AS chapter, v, text AS verse_text, count(*) AS n {_WITH_TEXT} GROUP BY ALL", _VERSES)
def verse_text_join(v: Views) -> DataFrame:
    """The distinct places of all works with their verses."""
    return _verse_texts(v, v.refs).groupBy("book_slug", "chapter", "v", "verse_text").agg(F.count("*").alias("n"))


@query(f"SELECT book_slug, ref_chapter AS chapter, v, text AS verse_text {_WITH_TEXT}", _VERSES)
def verse_text_join_all(v: Views) -> DataFrame:
    """The references of all works."""
    return _verse_texts(v, v.refs)


def _verse_texts(v: Views, refs: DataFrame) -> DataFrame:
    label = S.verse_label(F.col("verse_start"), F.col("verse_end"))
    keys = refs.select("book_slug", "chapter", label.alias("v"), S.verse_key(label).alias("verse_key"))
    verses = QUERIES["verse_dictionary"](v.spark, v.sf_dir)
    return explore.with_verse_text(keys, verses).select("book_slug", "chapter", "v", "verse_text")
