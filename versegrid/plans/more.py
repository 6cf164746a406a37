"""Queries of sources, sinks, orders and updates, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canon import is_roman, roman_to_int
from ..functions.registry import register
from ..operators import classify, explore, rollups, store, windows
from ..sources import texts
from .catalog import _CATEGORY, _COUNTED, _IN, _JOINED, _LABEL, CHOSEN, query
from .synth import Views


def placed(ordered: DataFrame) -> DataFrame:
    """Small ordered rows with their place, from 1, as the order gives them."""
    at = ordered.withColumn("m_", F.monotonically_increasing_id())
    return at.withColumn("place", F.row_number().over(Window.orderBy("m_"))).drop("m_")


# --- Index pages, the crawl and the manifest -------------------------------------------------------------------------

_LINKED = """linked AS (SELECT p_size AS page_id, p_partkey AS pos, p_partkey % 5 AS form, 'a' || p_partkey % 20 AS author_id, 'b' || p_partkey % 300 AS book_id,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'T' || p_partkey END AS label FROM part)"""


def _index_pages(v: Views) -> DataFrame:
    """Pages of an index: works in five forms of address, some without a label."""
    n = F.col("p_partkey")
    work = F.concat(F.lit("/ccel/a"), (n % 20).cast("string"), F.lit("/b"), (n % 300).cast("string"))
    form = n % 5
    href = (
        F.when(form == 0, F.concat(work, F.lit(".html"))).when(form == 1, F.concat(work, F.lit("?x=/1"))).when(form == 2, F.concat(work, F.lit("//#top")))
        .when(form == 3, F.concat(F.lit("/other/x"), n.cast("string"), F.lit(".html"))).otherwise(F.concat(F.when(n % 2 == 0, F.lit("http://far.example")).otherwise(F.lit("")), F.lit("/f/w"), n.cast("string"), F.lit(".TXT")))
    )
    label = F.when(n % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" <b>T"), n.cast("string"), F.lit("</b>\n")))
    tag = F.concat(F.lit("<li><A class='x' HREF = '"), href, F.lit("'>"), label, F.lit("</A>"))
    return v.raw("part").groupBy(F.col("p_size").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", tag.alias("tag")))), lambda x: x["tag"]), "\n").alias("html"))


@query("SELECT author_id, book_id, coalesce(nullif(arg_min(label, (page_id, pos)), ''), author_id || '/' || book_id) AS title FROM linked WHERE form = 0 GROUP BY author_id, book_id", _LINKED)
def text_index_works(v: Views) -> DataFrame:
    return texts.text_index(texts.links(_index_pages(v)))


@query(
    "SELECT author_id, book_id, arg_min(label, (page_id, pos)) AS title, arg_min('/ccel/' || author_id || '/' || book_id || CASE WHEN form = 0 THEN '.html' ELSE '' END, (page_id, pos)) AS href FROM linked WHERE form < 3 GROUP BY author_id, book_id",
    _LINKED,
)
def xml_index_works(v: Views) -> DataFrame:
    return texts.xml_index(texts.links(_index_pages(v)))


@query("SELECT page_id, arg_min(CASE WHEN pos % 2 = 0 THEN 'http://far.example' ELSE 'https://site.example' END || '/f/w' || pos || '.TXT', pos) AS url FROM linked WHERE form = 4 GROUP BY page_id", _LINKED)
def text_link_of_pages(v: Views) -> DataFrame:
    return texts.text_link(texts.links(_index_pages(v)), "https://site.example")


def _manifest(v: Views) -> DataFrame:
    n = F.col("s_suppkey")
    status = F.when(n % 3 == 0, "downloaded").when(n % 3 == 1, "cached").otherwise("failed")
    return v.raw("supplier").select(F.concat(F.lit("a"), (n % 20).cast("string")).alias("author_id"), F.concat(F.lit("b"), n.cast("string")).alias("book_id"), status.alias("status"), F.concat(F.lit("p"), n.cast("string")).alias("local_path"), F.lit(None).cast("string").alias("source_url"))


def _listed(v: Views) -> DataFrame:
    n = F.col("p_partkey")
    return v.raw("part").select(F.col("p_size").alias("page_id"), n.alias("pos"), F.concat(F.lit("a"), (n % 20).cast("string")).alias("author_id"), F.concat(F.lit("b"), n.cast("string")).alias("book_id"))


_MANIFEST = "manifest AS (SELECT 'a' || s_suppkey % 20 AS author_id, 'b' || s_suppkey AS book_id, ['downloaded', 'cached', 'failed'][s_suppkey % 3 + 1] AS status, 'p' || s_suppkey AS local_path FROM supplier)"
_WORKS_LISTED = "listed AS (SELECT p_size AS page_id, p_partkey AS pos, 'a' || p_partkey % 20 AS author_id, 'b' || p_partkey AS book_id FROM part)"


@query(
    "SELECT l.author_id, l.book_id, CASE WHEN m.status <> 'failed' THEN 'cached' ELSE 'wanted' END AS status, CASE WHEN m.status <> 'failed' THEN local_path END AS local_path FROM (SELECT * FROM listed ORDER BY page_id, pos LIMIT 150) l LEFT JOIN manifest m USING (author_id, book_id)",
    f"{_MANIFEST}, {_WORKS_LISTED}",
)
def crawl_plan(v: Views) -> DataFrame:
    """The first 150 works of an index; the limit is what the crawl is asked for."""
    return texts.crawl(_listed(v), _manifest(v), limit=150).select("author_id", "book_id", "status", "local_path")


@query("SELECT author_id, book_id, 'wanted' AS status FROM listed", _WORKS_LISTED)
def crawl_forced(v: Views) -> DataFrame:
    return texts.crawl(_listed(v), _manifest(v), force=True).select("author_id", "book_id", "status")


@query("SELECT author_id, book_id FROM listed WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.author_id = listed.author_id AND m.book_id = listed.book_id)", f"{_MANIFEST}, {_WORKS_LISTED}")
def not_downloaded(v: Views) -> DataFrame:
    return texts.to_download(_listed(v), _manifest(v)).select("author_id", "book_id")


_LOCAL = ", ".join(f"('{a}', '{t}', '{f}', NULL)" for a, t, f in texts.LOCAL_WORKS)


@query(f"SELECT author, title, filename, ccel_url AS txt_url FROM works UNION ALL SELECT * FROM (VALUES {_LOCAL})")
def listed_and_local_works(v: Views) -> DataFrame:
    return texts.all_works(v.works.withColumn("txt_url", F.col("ccel_url")))


@query("""SELECT l_orderkey AS work, arg_min('u' || l_linenumber, l_linenumber) AS url FROM lineitem WHERE l_linenumber % 2 = 1 AND l_quantity > 25 AND l_partkey % 3 > 0 GROUP BY 1""")
def first_valid_download(v: Views) -> DataFrame:
    """Candidates by line: status 200 on odd lines, long enough beyond a quantity of 25, with an early tag but for one part in three."""
    content = F.concat(F.when(F.col("l_partkey") % 3 == 0, F.lit(" " * 200)).otherwise(F.lit("x")), F.lit("<"), F.when(F.col("l_quantity") > 25, F.lit("y" * 500)).otherwise(F.lit("y")))
    rows = v.raw("lineitem").select(F.col("l_orderkey").alias("work"), F.col("l_linenumber").alias("pos"), F.concat(F.lit("u"), F.col("l_linenumber").cast("string")).alias("url"), F.when(F.col("l_linenumber") % 2 == 1, 200).otherwise(404).alias("status"), content.cast("binary").alias("content"))
    return texts.first_download(rows)


# --- Texts of works --------------------------------------------------------------------------------------------------


@query("""SELECT filename, CASE WHEN known THEN a WHEN id % 5 = 0 THEN NULL ELSE 'F' || id || ' L' || id END AS author, CASE WHEN known THEN t ELSE 'Title ' || id END AS title,
  CAST(CASE WHEN known THEN y WHEN id % 4 = 0 THEN 1500 + id % 300 END AS INT) AS year,
  CASE WHEN known THEN u WHEN id % 5 > 0 AND id % 3 > 0 THEN 'https://ccel.org/ccel/au_' || id || '/wk' END AS ccel_url
FROM (SELECT id, CASE WHEN id = 1 THEN 'mort.txt' WHEN id = 2 THEN 'sermons.txt' WHEN id % 3 = 0 THEN 'w' || id || '.txt' ELSE 'au_' || id || '_wk.txt' END AS filename, id IN (1, 2) AS known,
  CASE id WHEN 1 THEN 'John Owen' WHEN 2 THEN 'Meister Eckhart' END AS a, CASE id WHEN 1 THEN 'Of the Mortification of Sin in Believers' WHEN 2 THEN 'Sermons' END AS t,
  CASE id WHEN 1 THEN 1656 WHEN 2 THEN 1300 END AS y, CASE id WHEN 1 THEN 'https://ccel.org/ccel/owen/mort' END AS u FROM works)""")
def text_works(v: Views) -> DataFrame:
    """Metadata of text files from their headers or the overrides, with addresses from their names."""
    n, rule = F.col("id").cast("string"), F.lit("_" * 12 + "\n")
    name = F.when(F.col("id") == 1, "mort.txt").when(F.col("id") == 2, "sermons.txt").when(F.col("id") % 3 == 0, F.concat(F.lit("w"), n, F.lit(".txt"))).otherwise(F.concat(F.lit("au_"), n, F.lit("_wk.txt")))
    by = F.when(F.col("id") % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(" Creator(s): L"), n, F.lit(", St. F"), n, F.lit(" (d. 900)\n")))
    basis = F.when(F.col("id") % 4 == 0, F.concat(F.lit("Print Basis: Oxford "), (1500 + F.col("id") % 300).cast("string"), F.lit(", 2nd\n"))).otherwise(F.lit("Print Basis: n. d. 12345\n"))
    return texts.text_works(v.works.select(name.alias("filename"), F.concat(rule, F.lit("Title: Title "), n, F.lit("\n"), by, basis, rule, F.lit("body\n")).alias("text")))


_SPANS = "spans AS (SELECT DISTINCT filename, id, passage_start_offset AS a, passage_end_offset AS b FROM refs JOIN works ON id = manuscript_id)"


def _span_texts(v: Views) -> DataFrame:
    """Every work but each tenth has a text, of one word that repeats with the work's number and blank runs."""
    line = F.concat(F.lit("wörd "), F.col("id").cast("string"), F.lit("\n\n\n\n"))
    return v.works.where("id % 10 <> 7").select("filename", F.repeat(line, 300).alias("text"))


@query(
    "SELECT filename, a AS passage_start_offset, b AS passage_end_offset, CASE WHEN id % 10 = 7 THEN '[source file not found: ' || filename || ']' ELSE regexp_replace(regexp_replace(substr(repeat('wörd ' || id || chr(10) || chr(10) || chr(10) || chr(10), 300), a + 1, b - a), '^\\s+|\\s+$', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g') END AS passage FROM spans",
    _SPANS,
)
def passage_dictionary(v: Views) -> DataFrame:
    return windows.passages(v.refs, v.works, _span_texts(v))


@query(
    f"SELECT r.manuscript_id AS w, {_LABEL} AS v, coalesce(author, '') AS author, substr(repeat('x' || w.id % 10, 3000), r.passage_start_offset + 1, r.passage_end_offset - r.passage_start_offset) AS passage FROM {_JOINED} WHERE book_slug = 'genesis' AND chapter = 3 AND coalesce(nullif(author, ''), 'Unknown') = 'Author 3'",
)
def chapter_listing_of_author(v: Views) -> DataFrame:
    """One author's references to a chapter with their passages, as the view's filters ask for."""
    bodies = v.works.select("filename", F.repeat(F.concat(F.lit("x"), (F.col("id") % 10).cast("string")), 3000).alias("text"))
    asked = v.refs.where("book_slug = 'genesis' AND chapter = 3")
    found = explore.chapter_listing(v.refs, v.works, windows.passages(asked, v.works, bodies), "genesis", 3, author="Author 3")
    return found.select("w", "v", F.coalesce("author", F.lit("")).alias("author"), "passage")


@query(f"SELECT book_slug, book || ' ' || chapter || coalesce(':' || {_LABEL}, '') AS place FROM {_JOINED} WHERE manuscript_id = 7 AND book_slug = 'romans'")
def work_listing_of_book(v: Views) -> DataFrame:
    return explore.work_listing(v.refs, v.works, 7, "romans").select("book_slug", "place")


# --- Orders ----------------------------------------------------------------------------------------------------------


@query(
    "SELECT verse_key, n, CAST(row_number() OVER (ORDER BY verse_key <> 'whole', TRY_CAST(verse_key AS INT)) AS INT) AS place FROM keyed",
    f"keyed AS (SELECT coalesce(CAST(verse_start AS VARCHAR), 'whole') AS verse_key, count(*) AS n FROM {_JOINED} WHERE chapter = 3 AND book_slug = 'genesis' AND {_CATEGORY} IN ({_IN}) GROUP BY ALL)",
)
def verse_table_order(v: Views) -> DataFrame:
    return placed(explore.verse_table(v.refs, v.works, "genesis", 3, CHOSEN).select("verse_key", "n"))


@query(
    f"SELECT id, row_number() OVER (PARTITION BY id ORDER BY book_slug, chapter, coalesce(verse_start, 2147483647), v NULLS FIRST, p) AS place, book_slug, chapter, v, p FROM (SELECT w.id, book_slug, chapter, verse_start, {_LABEL} AS v, regexp_replace(filename, '\\.txt$', '') || '_' || passage_start_offset || '_' || passage_end_offset AS p FROM {_JOINED})",
)
def work_references(v: Views) -> DataFrame:
    return rollups.work_references(v.refs, v.works).select("id", "place", "book_slug", "chapter", "v", "p")


@query(
    f"SELECT id, author, title, ref_count, CAST(row_number() OVER (ORDER BY author, title, id) AS INT) AS place FROM (SELECT id, coalesce(nullif(author, ''), 'Unknown') AS author, coalesce(nullif(title, ''), filename) AS title, ref_count FROM works JOIN counted USING (id))",
    _COUNTED,
)
def index_works(v: Views) -> DataFrame:
    """The works of the index in its order."""
    return rollups.index_works(v.refs, v.works).select("id", "author", "title", "ref_count", F.col("place").cast("int").alias("place"))


@query(f"""SELECT book_slug, CAST(row_number() OVER (PARTITION BY book_slug ORDER BY chapter) AS INT) AS place, chapter, n FROM (
  SELECT book_slug, chapter, count(*) AS n FROM {_JOINED} JOIN canon c ON c.slug = book_slug WHERE chapter BETWEEN 1 AND c.chapters GROUP BY ALL)""")
def index_books(v: Views) -> DataFrame:
    """The chapter counts of the index's books, in its order."""
    return rollups.index_books(v.refs, v.works).select("book_slug", "place", "chapter", "n")


@query(f"SELECT book_slug, book, chapter, count(*) AS n_refs, sha256(string_agg(coalesce({_LABEL}, '-') || '/' || manuscript_id, ',' ORDER BY coalesce(verse_start, 2147483647), coalesce(author, ''), coalesce(title, ''), coalesce({_LABEL}, ''), manuscript_id)) AS listed FROM {_JOINED} WHERE book_slug = 'romans' GROUP BY ALL")
def book_slice(v: Views) -> DataFrame:
    """The payload of one book, as a build that is asked for it makes it."""
    rows = rollups.chapter_payloads(v.refs, v.works, only="romans")
    told = F.array_join(F.transform("refs", lambda r: F.concat(F.coalesce(r["v"], F.lit("-")), F.lit("/"), r["w"].cast("string"))), ",")
    return rows.select("book_slug", "book", "chapter", F.size("refs").cast("bigint").alias("n_refs"), F.sha2(told.cast("binary"), 256).alias("listed"))


@query("SELECT id, n, list_aggregate(list_sort(list_transform(range(n), lambda i: CAST(id AS VARCHAR) || '.' || i)), 'string_agg', ',') AS parts FROM (SELECT id, CAST(ref_count AS BIGINT) AS n FROM counted)", _COUNTED)
def packed_roundtrip(v: Views) -> DataFrame:
    """Payloads through compressed JSON and back."""
    counted = rollups.work_counts(v.refs, v.works).select("id", F.col("ref_count").alias("n"), F.array_sort(F.transform(F.sequence(F.lit(0), F.col("ref_count").cast("int") - 1), lambda i: F.concat(F.col("id").cast("string"), F.lit("."), i.cast("string")))).alias("parts"))
    back = texts.unpacked(texts.packed(counted, F.col("id").cast("string")))
    return back.select(F.from_json("value", "id bigint, n bigint, parts array<string>").alias("x")).select("x.id", "x.n", F.array_join("x.parts", ",").alias("parts"))


# --- Updates and numerals --------------------------------------------------------------------------------------------

NEW_NAMES = 200_000


@query(f"""SELECT id, filename FROM works UNION ALL
SELECT (SELECT max(id) FROM works) + row_number() OVER (ORDER BY filename), filename FROM (SELECT 'n' || lpad(CAST(i * 7919 % {NEW_NAMES} AS VARCHAR), 6, '0') AS filename FROM range({NEW_NAMES}) t(i))""")
def upsert_many(v: Views) -> DataFrame:
    """As many new names as bring adaptive execution to other partitions than planned."""
    name = F.concat(F.lit("n"), F.lpad((F.col("id") * 7919 % NEW_NAMES).cast("string"), 6, "0"))
    new = v.works.where("id % 4 = 0").unionByName(v.spark.range(NEW_NAMES).select(name.alias("filename")), allowMissingColumns=True)
    return store.upsert(v.works, new).select("id", "filename")


_YEAR_ROWS = ", ".join(f"('{n}', {y})" for n, y in (line.rsplit(" ", 1) for line in store.YEARS.strip().split("\n")))


@query(f"SELECT filename, CAST(year AS INT) AS year FROM (VALUES {_YEAR_ROWS}) t(filename, year) UNION ALL SELECT filename, year FROM works")
def known_year_update(v: Views) -> DataFrame:
    """The table of known years over works of which it knows some."""
    known = store.known_years(v.spark)
    some = known.select("filename", F.lit(1).alias("year"))
    works = v.works.select("id", "filename", "year").unionByName(some, allowMissingColumns=True)
    return store.update_years(works, known).select("filename", "year")


_DIGITS = "list_transform(string_split(upper(w), ''), lambda x: CASE x WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 ELSE 1000 END)"


@query(
    "SELECT doc_id, count(*) AS words, count(*) FILTER (spelled) AS spelled, CAST(coalesce(sum(list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN i < len(d) AND d[i] < d[i + 1] THEN -d[i] ELSE d[i] END))) FILTER (spelled), 0) AS BIGINT) AS total FROM worded GROUP BY doc_id",
    rf"""worded AS (SELECT doc_id, regexp_full_match(w, '[ivxlcdmIVXLCDM]+') AS spelled, {_DIGITS} AS d FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM documents))""",
)
def roman_spelling(v: Views) -> DataFrame:
    """Words of the documents that are written in numerals, and the sum of their values."""
    words = v.raw("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("w"))
    told = words.select("doc_id", is_roman(F.col("w")).alias("spelled"), roman_to_int(F.col("w")).cast("bigint").alias("value"))
    return told.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_if("spelled").alias("spelled"), F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("total"))


@query("SELECT id, ref_count, greatest(3.0, least(13.0, 3 + ref_count / (max(ref_count) OVER ()) * 10))::DOUBLE AS radius FROM counted", _COUNTED)
def marker_radii(v: Views) -> DataFrame:
    """The marker of each work on the timeline."""
    n = rollups.work_counts(v.refs, v.works).select("id", "ref_count")
    most = n.agg(F.max("ref_count").alias("most"))
    return n.crossJoin(F.broadcast(most)).select("id", "ref_count", S.marker_radius(F.col("ref_count"), F.col("most")).alias("radius"))


@query("SELECT l_orderkey, l_linenumber, manuscript_id, book_slug, chapter, verse_start, verse_end, citation_offset FROM cited")
def citations_by_sql(v: Views) -> DataFrame:
    """The extraction as SQL calls it."""
    register(v.spark)
    v.citation_texts.createOrReplaceTempView("citation_texts_")
    return v.spark.sql("SELECT id.*, c.book_slug, c.chapter, c.verse_start, c.verse_end, c.citation_offset FROM citation_texts_, LATERAL extract_citations(text) c")


# --- Every rule of the classifier ------------------------------------------------------------------------------------

# The classifier's rules once more, as SQL in their order and apart from the library's own list, so that a value that is wrong in either shows.
_RULES = [
    ("Patristics", "f", "anf|npnf"),
    ("Biblical Commentary", "f", "expositor|commentary"),
    ("Biblical Commentary", "t", "expositor|commentary|^(an? )?exposition of\\b|word pictures|bible studies|synthetic bible"),
    ("Scripture", "s", "bibles|bible"),
    ("Scripture", "t", "catechism|confession of faith|heidelberg|westminster|book of jasher|book of common prayer|augsburg confession|apology of the augsburg|scottish confession|scots confession"),
    ("Patristics", "s", "early|early church"),
    ("Patristics", "y", "year < 600"),
    ("Patristics", "a", "augustine|athanasius|cassian|chrysostom|origen|jerome|ambrose|basil|gregory|cyprian|tertullian|irenaeus|clement|eusebius|lactantius|hilary|leo|cyril|ephrem|ignatius|polycarp|papias|dionysius"),
    ("Patristics", "t", "apostolic fathers|early christian|early church"),
    ("Patristics", "saint", "alexandria|hippo|antioch|carthage|caesarea"),
    ("Medieval", "s", "mysticism"),
    ("Medieval", "y", "year >= 600 AND year < 1500"),
    ("Medieval", "a", "eckhart|bonaventure|bernard|anselm|matelda|aquinas|guyon|tauler|rolle|hilton|kempe|kempis|fenelon|law"),
    ("Medieval", "f", "cloud"),
    ("Systematic Theology", "a", "berkhof|bavinck|hodge|warfield|turretin|dabney|kuyper|forsyth"),
    ("Systematic Theology", "t", "systematic theology|dogmatics|dogmatic theology"),
    ("Church History", "s", "history"),
    ("Church History", "t", "history|historical|huguenot"),
    ("Church History", "f", "history|huguenot"),
    ("Church History", "a", "menno simon"),
    ("Church History", "t", "^(life of|lives of)\\b|eirenicon|primitive christianity|rise and progress|american religious movement"),
    ("Reformation", "a", "calvin|luther|melanchthon|zwingli|knox|tyndale|cranmer|beza|bucer|bullinger|erasmus"),
    ("Reformation", "t", "institutes|bondage of the will|small catechism|large catechism|smalcald|formula of concord|thirty-nine articles|confutatio|pulpit of the reformation"),
    ("Puritan", "a", "owen|baxter|bunyan|flavel|goodwin|watson|boston|manton|howe|gurnall|charnock|sibbes|allestree|mason|rutherford|mead|vincent|swinnock|love|edwards|shepard|fisher|arndt"),
    ("Sermons", "a", "spurgeon|maclaren|moody|whyte|dods"),
    ("Sermons", "t", "sermon"),
    ("Sermons", "f", "sermon"),
    ("Apologetics", "a", "chesterton|macdonald|kierkegaard|plantinga|lewis|pascal|newman|sayers|coleridge"),
    ("Apologetics", "t", "apologetics|defence of|defense of"),
    ("Devotional", "a", "murray|pink|torrey|smith|gordon|havergal|underhill|fenelon|wesley|newton|moule|orr|quadrupani|steele|upham|pasko|inge|oman"),
    ("Devotional", "s", "christian life"),
    ("Devotional", "t", "devotion|prayer|meditation|spiritual|way of peace|way of holiness|holy living|mortification|imitation|uniformity|piety|the soul of|waiting on|with christ|comfort for|christian's secret|kept for|love enthroned|plain account of christian"),
    ("Devotional", "t", "hymn|hymns|psalms and hymns|spiritual songs|sacred songs|night thoughts|religious poems|poetical works|divine songs|sacred hymns"),
    ("Devotional", "f", "hymn"),
    ("Devotional", "t", "light and peace|holy life|in his steps|to my younger|comfort against|sufferings of christ|maxims of the saints|meditating on scripture|reflections on the christian|quiet talks"),
    ("Biblical Commentary", "t", "helps to the study|revision revised|genesis to revelation|notes on the bible|bible gallery"),
    ("Medieval", "t", "eckhart"),
    ("Church History", "t", "thomas boston|psalmody|william carey"),
    ("Patristics", "a", "philo"),
]


def _quoted(said: str) -> str:
    return "'" + said.replace("'", "''") + "'"


def _rules_sql() -> str:
    column = {"f": "lower(filename)", "a": "lower(coalesce(author, ''))", "t": "lower(coalesce(title, ''))"}
    cases = []
    for name, field, said in _RULES:
        if field == "y":
            holds = f"coalesce(year <> 0 AND {said}, FALSE)"
        elif field == "s":
            holds = f"coalesce(subject IN ({', '.join(map(_quoted, said.split('|')))}), FALSE)"
        elif field == "saint":
            holds = f"regexp_matches({column['t']}, {_quoted(said)}) AND regexp_matches({column['t']}, '\\bst\\.?\\s+\\w+ of \\w+')"
        else:
            holds = f"regexp_matches({column[field]}, {_quoted(said)})"
        cases.append(f"WHEN {holds} THEN {_quoted(name)}")
    return f"CASE {' '.join(cases)} ELSE 'Other' END"


def _said(fields: str) -> list[str]:
    """All fragments of some fields; patterns stand as an example and what nearly is one."""
    plain = {"^(an? )?exposition of\\b": ["exposition of x", "an exposition of x", "the exposition of x", "exposition often"], "^(life of|lives of)\\b": ["life of x", "the lives of x", "life often"]}
    out = []
    for _, field, said in _RULES:
        if field in fields.split():
            rest = said
            for pattern, shown in plain.items():
                if pattern in rest:
                    out, rest = out + shown, rest.replace(pattern, "").strip("|")
            words = rest.split("|")
            out += words + ([f"st. xy of {w}" for w in words] + [f"st xy to {w}" for w in words] if field == "saint" else [])
    return out


def _pick(words: list[str], n: str) -> str:
    """SQL of the list's element by a number, none at every third."""
    return f"CASE WHEN ({n}) % 3 > 0 THEN ([{', '.join(map(_quoted, words))}])[CAST(({n}) // 3 % {len(words)} + 1 AS INT)] END"


def _planted_sql() -> str:
    near = lambda words, n: f"CASE WHEN ({n}) % 2 = 0 THEN upper({_pick(words, n)}) ELSE 'Q' || ({_pick(words, n)}) || 'q' END"
    return f"""planted AS (SELECT l_orderkey, l_linenumber, id, {near(_said('f'), 'l_orderkey')} || '_' || w.filename AS filename,
    coalesce(w.author || ' and ', '') || {near(_said('a'), 'l_orderkey * 7 + l_partkey')} AS author, {near(_said('t saint'), 'l_partkey * 5 + l_orderkey * 3 + l_linenumber')} AS title,
    CASE WHEN l_partkey % 4 = 0 THEN w.year WHEN l_partkey % 4 = 1 THEN CAST(l_orderkey % 2 * 599 + l_linenumber // 4 AS INT) WHEN l_partkey % 8 = 2 THEN 1499 END AS year, {_pick(_said('s'), 'l_partkey + l_linenumber')} AS subject
  FROM lineitem JOIN works w ON w.id = l_suppkey)"""


@query(f"SELECT l_orderkey, l_linenumber, id, {_rules_sql()} AS category FROM (SELECT * REPLACE (coalesce(filename, 'x') AS filename) FROM planted)", _planted_sql())
def classify_every_rule(v: Views) -> DataFrame:
    """All works, with every fragment of every rule planted in their names, authors and titles, alone and beside others'."""

    def pick(words: list[str], n: Column) -> Column:
        return F.when(n % 3 > 0, F.element_at(F.array(*map(F.lit, words)), (F.floor(n / 3) % len(words) + 1).cast("int")))

    def near(words: list[str], n: Column) -> Column:
        return F.when(n % 2 == 0, F.upper(pick(words, n))).otherwise(F.concat(F.lit("Q"), pick(words, n), F.lit("q")))

    key, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    rows = v.raw("lineitem").join(v.works.withColumnRenamed("id", "l_suppkey"), "l_suppkey")
    author = F.concat(F.coalesce(F.concat("author", F.lit(" and ")), F.lit("")), near(_said("a"), key * 7 + part))
    year = F.when(part % 4 == 0, F.col("year")).when(part % 4 == 1, (key % 2 * 599 + F.floor(line / 4)).cast("int")).when(part % 8 == 2, 1499)
    name = F.coalesce(F.concat(near(_said("f"), key), F.lit("_"), F.col("filename")), F.lit("x"))
    subject = pick(_said("s"), part + line)
    told = classify.category(name, author, near(_said("t saint"), part * 5 + key * 3 + line), year, F.when(subject.isNotNull(), F.array(F.lit("none"), subject)))
    return rows.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("id"), told.alias("category"))


@query("SELECT filename, CASE WHEN id % 3 = 0 THEN 'history' WHEN id % 3 = 1 THEN 'early,mysticism' ELSE '' END AS subjects FROM works")
def subjects_with_archive(v: Views) -> DataFrame:
    """Subjects of works from their texts, of every third from the archive, where others' older texts are passed over."""
    rule = F.lit("_" * 10 + "\n")
    text = lambda said: F.concat(F.lit("x\n"), rule, F.lit(" Title: T\n"), said, rule, F.lit("body\n"))
    there = v.works.where("id % 3 <> 0").select("filename", text(F.when(F.col("id") % 3 == 1, F.lit("CCEL Subjects: Early; Mysticism; early\n")).otherwise(F.lit(""))).alias("text"))
    archived = v.works.where("id % 3 <> 1").select("filename", text(F.lit("ccel subjects: History;\n")).alias("text"))
    return classify.subjects_of(there, archived).select("filename", F.array_join("subjects", ",").alias("subjects"))


@query("SELECT id, CASE id % 7 WHEN 0 THEN 'F' || id || ' L' || id WHEN 1 THEN 'L' || id WHEN 2 THEN 'L' || id WHEN 3 THEN 'Anonymous' WHEN 4 THEN 'F' || id || ' L' || id WHEN 5 THEN 'St. L' || id END AS author FROM works")
def creators(v: Views) -> DataFrame:
    """Names in the shapes that headers have them in: honorifics, roles, dates, anonyms, one part, none."""
    n = F.col("id").cast("string")
    shapes = [("L", ", Rev. F", " (1600-1650)"), ("L", "", " (fl. 900)"), ("L", ", Archbishop of X", ""), ("Anon. ", "", ""), ("L", ", Saint, F", " "), ("L", ", St. (d. 3)", None)]
    made = F.lit(None).cast("string")
    for i, (first, second, end) in enumerate(shapes):
        parts = [F.lit(first), n, F.lit(second)] + ([] if end is None or not second or "of" in second else [n]) + [F.lit(end or "")]
        made = F.when(F.col("id") % 7 == i, F.concat(*parts)).otherwise(made)
    return v.works.select("id", S.creator(made).alias("author"))
