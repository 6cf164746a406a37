"""Views of works, references and texts over the generated tables.

A view's SQL is written once in what Spark and DuckDB share; table names stand
in braces, so the same text serves the query and its oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import books, canon, int_to_roman

_CATEGORIES = ("Patristics", "Biblical Commentary", "Scripture", "Medieval", "Systematic Theology", "Church History", "Reformation", "Puritan", "Sermons", "Apologetics", "Devotional", "Other")
_CASES = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CATEGORIES))

WORKS = f"""
SELECT s_suppkey AS id, 'w' || CAST(s_suppkey AS STRING) || '.txt' AS filename,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 'Author ' || CAST(s_suppkey % 17 AS STRING) END AS author,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_name END AS title,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(100 + (s_suppkey * 37) % 1800 AS INT) END AS year,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'https://site.example/' || CAST(s_suppkey % 40 AS STRING) END AS ccel_url,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CASE s_suppkey % 12 {_CASES} END END AS category,
  CASE WHEN s_suppkey % 2 = 0 THEN 'txt' ELSE 'thml' END AS source_format
FROM {{supplier}}"""
_REF = """
SELECT l_suppkey AS manuscript_id, l_orderkey, l_linenumber, c.name AS book, c.slug AS book_slug,
  CAST(l_orderkey % c.chapters + 1 AS INT) + {beyond} AS chapter,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_quantity AS INT) END AS verse_start,
  CASE WHEN (l_orderkey + l_linenumber) % 6 >= 3 AND l_linenumber <> 5 THEN CAST(l_quantity AS INT) + l_linenumber END AS verse_end,
  CAST(l_orderkey % 5000 AS INT) AS citation_offset, CAST((l_orderkey % 50) * 100 AS INT) AS passage_start_offset,
  CAST((l_orderkey % 50) * 100 + 100 + l_linenumber * 10 AS INT) AS passage_end_offset
FROM {{lineitem}} JOIN {{canon}} c ON c.book_order = l_partkey % 82 + 1"""
REFS = _REF.format(beyond="CASE WHEN l_orderkey % 97 = 0 THEN 200 ELSE 0 END") + " WHERE l_suppkey % 10 <> 3"
#: What the citation texts say: chapters that the book has, for all works.
SAID = _REF.format(beyond="0")
YEARS = """
SELECT filename, CAST(id % 900 + 900 AS INT) AS year FROM {works} WHERE id % 4 = 0
UNION ALL SELECT 'x' || filename, 1000 FROM {works} WHERE id % 9 = 1"""
OUTPUTS = "SELECT id, CASE WHEN id % 3 = 0 THEN year + 1 WHEN id % 10 = 1 THEN NULL ELSE year END AS year FROM {works}"
ATTRIBUTES = """
SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 8
    WHEN 0 THEN 'esv|' || c.slug || '|' || CAST(ch AS STRING) || '|x|0|0'
    WHEN 1 THEN 'esv|' || c.name || '|0|0|0|0'
    WHEN 2 THEN 'esv|' || c.name || '|' || CAST(ch AS STRING) || '|1|0'
    WHEN 3 THEN '|Nowhere|1|1|0|0; ;|' || upper(c.name) || '|' || CAST(ch AS STRING) || '|0|0|0'
    ELSE '|' || c.name || '|' || CAST(ch AS STRING) || '|' || CAST(vs AS STRING) || '|' || CAST(ch + 1 AS STRING) || '|' || CAST(ve AS STRING) END AS parsed
FROM (SELECT *, l_orderkey % 7 + 1 AS ch, CAST(l_quantity AS INT) AS vs, CAST(l_quantity AS INT) + l_linenumber % 3 AS ve FROM {lineitem}) r JOIN {canon} c ON c.book_order = l_partkey % 82 + 1"""


_TENS, _ONES = (["", *x.split()] for x in ("x xx xxx xl l lx lxx lxxx xc", "i ii iii iv v vi vii viii ix"))
#: The citation texts as SQL for DuckDB, with numerals from tables of digits.
CITED = f"""
SELECT l_orderkey, l_linenumber, manuscript_id, s.book, s.book_slug, chapter, verse_start, verse_end, CASE WHEN l_orderkey % 5 = 0 THEN 5 ELSE 3 END AS citation_offset,
  CASE WHEN l_orderkey % 5 = 0 THEN '😀 zz ' ELSE 'zz ' END || CASE
    WHEN verse_start IS NULL THEN CASE WHEN form IN (0, 3) THEN s.book || ' ' || chapter WHEN form IN (1, 4) THEN first_abbrev || '. ' || roman ELSE upper(first_abbrev) || '. ' || chapter END
    WHEN form = 0 THEN s.book || ' ' || chapter || ':' || verse_start WHEN form = 1 THEN first_abbrev || '. ' || roman || '. ' || verse_start WHEN form = 2 THEN upper(first_abbrev) || '. ' || chapter || '. ' || verse_start
    WHEN form = 3 THEN first_abbrev || '. ' || roman || '. ' || verse_start || '-' || verse_end WHEN form = 4 THEN s.book || ' ' || chapter || ':' || verse_start || '–' || verse_end
    ELSE first_abbrev || '. ' || chapter || '. ' || verse_start || ', ' || verse_end END || ' ;' AS text
FROM (SELECT *, (l_orderkey + l_linenumber) % 6 AS form, repeat('c', CAST(chapter // 100 AS INT)) || ({_TENS})[chapter // 10 % 10 + 1] || ({_ONES})[chapter % 10 + 1] AS roman FROM said) s JOIN canon c ON c.slug = s.book_slug"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass
class Views:
    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def dealt(self, name: str) -> DataFrame:
        """A table whose rows become much work each; one that is read in fewer parts than there are cores is dealt to all of them."""
        rows = self.raw(name)
        cores = self.spark.sparkContext.defaultParallelism
        return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows

    @property
    def canon(self) -> DataFrame:
        return F.broadcast(canon(self.spark))

    @property
    def works(self) -> DataFrame:
        return self.spark.sql(WORKS, supplier=self.raw("supplier"))

    @property
    def refs(self) -> DataFrame:
        return self.spark.sql(REFS, lineitem=self.raw("lineitem"), canon=self.canon)

    @property
    def years(self) -> DataFrame:
        return self.spark.sql(YEARS, works=self.works)

    @property
    def outputs(self) -> DataFrame:
        return self.spark.sql(OUTPUTS, works=self.works)

    @property
    def attributes(self) -> DataFrame:
        return self.spark.sql(ATTRIBUTES, lineitem=self.dealt("lineitem"), canon=self.canon)

    @property
    def citation_texts(self) -> DataFrame:
        """One citation a text, written in one of six forms, some behind a character beyond the basic plane."""
        said = self.spark.sql(SAID, lineitem=self.dealt("lineitem"), canon=self.canon)
        short = self.canon.select(F.col("slug").alias("book_slug"), "first_abbrev")
        form = (F.col("l_orderkey") + F.col("l_linenumber")) % 6
        ch, roman = F.col("chapter").cast("string"), int_to_roman(F.col("chapter"))
        vs, ve = F.col("verse_start").cast("string"), F.col("verse_end").cast("string")
        low, up = F.concat("first_abbrev", F.lit(". ")), F.concat(F.upper("first_abbrev"), F.lit(". "))
        full = F.concat("book", F.lit(" "))
        alone = F.when(form.isin(0, 3), F.concat(full, ch)).when(form.isin(1, 4), F.concat(low, roman)).otherwise(F.concat(up, ch))
        whole = (
            F.when(form == 0, F.concat(full, ch, F.lit(":"), vs)).when(form == 1, F.concat(low, roman, F.lit(". "), vs)).when(form == 2, F.concat(up, ch, F.lit(". "), vs))
            .when(form == 3, F.concat(low, roman, F.lit(". "), vs, F.lit("-"), ve)).when(form == 4, F.concat(full, ch, F.lit(":"), vs, F.lit("–"), ve)).otherwise(F.concat(low, ch, F.lit(". "), vs, F.lit(", "), ve))
        )
        before = F.when(F.col("l_orderkey") % 5 == 0, F.lit("\U0001f600 zz ")).otherwise(F.lit("zz "))
        text = F.concat(before, F.when(F.col("verse_start").isNull(), alone).otherwise(whole), F.lit(" ;"))
        return said.join(short, "book_slug").select(F.struct("l_orderkey", "l_linenumber", "manuscript_id").alias("id"), text.alias("text"))


def _canon_sql() -> str:
    rows = ", ".join(f"('{b.name}', '{b.slug}', {b.order}, {b.chapters}, '{(b.abbrevs or (b.name.lower(),))[0]}', '{b.group}', {b.group_order})" for b in books())
    return f"SELECT * FROM (VALUES {rows}) AS t(name, slug, book_order, chapters, first_abbrev, book_group, group_order)"


def oracle(body: str) -> str:
    """``body`` with the views that it may use in front."""
    views = {"canon": _canon_sql(), "works": WORKS, "refs": REFS, "said": SAID, "years": YEARS, "outputs": OUTPUTS, "attributes": ATTRIBUTES, "cited": None}
    names = {n: n for n in ("supplier", "lineitem", "canon", "works")}
    return "WITH " + ",\n".join(f"{n} AS ({CITED if sql is None else sql if n == 'canon' else sql.format(**names)})" for n, sql in views.items()) + "\n" + body
