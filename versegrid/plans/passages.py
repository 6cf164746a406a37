"""Queries of native sentences and of windows of stored references, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from ..operators import citations, sentences, windows
from .catalog import ORACLES, _citation_sql, _passage_works, _wrapped, query
from .synth import Views, oracle

_SPACE_SQL = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_ABBREVIATION_SQL = rf"""(^|[^\p{{L}}\p{{N}}_])((?i:{'|'.join(sorted(sentences.NO_END, key=len, reverse=True))}){_SPACE_SQL}*[.!?]["'')]*){_SPACE_SQL}+([A-Z"(\[])"""
_CUT_SQL = rf"""([.!?]["'')]*){_SPACE_SQL}+([A-Z"(\[])"""
_ONCE = rf"regexp_replace(text, '{_ABBREVIATION_SQL}', '\1\2' || chr(2) || '\3', 'g')"
_TWICE = _ONCE.replace("text", _ONCE, 1)


def _sentences_sql(source: str, keys: str) -> str:
    """``sentences`` (keys, g, said) of a table's texts by two replacements; the first runs twice, as each match takes the letter behind it."""
    return rf"""cuts AS (SELECT {keys}, string_split(regexp_replace({_TWICE}, '{_CUT_SQL}', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM {source}),
  pieces AS (SELECT {keys}, i, regexp_replace(replace(p, chr(2), ''), '^{_SPACE_SQL}+|{_SPACE_SQL}+$', '', 'g') AS said FROM (SELECT {keys}, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM cuts)),
  grouped AS (SELECT {keys}, i, said, sum(CASE WHEN r = 1 OR length(said) >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY i) AS g FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY i) AS r FROM pieces WHERE said <> '')),
  sentences AS (SELECT {keys}, g, string_agg(said, ' ' ORDER BY i) AS said FROM grouped GROUP BY {keys}, g)"""


@query("SELECT doc_id, count(*) AS n, max(length(said)) AS longest, sha256(string_agg(said, chr(1) ORDER BY g)) AS told FROM sentences GROUP BY doc_id", _sentences_sql("documents", "doc_id"))
def document_sentences(v: Views) -> DataFrame:
    """The sentences of all documents, each a paragraph, natively."""
    rows = v.raw("documents").select("doc_id", sentences.sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    return rows.select("doc_id", F.size("s").cast("bigint").alias("n"), F.array_max(F.transform("s", F.length)).cast("bigint").alias("longest"), F.sha2(F.array_join("s", "\u0001").cast("binary"), 256).alias("told"))


def _stored(rows: DataFrame, passage: bool = False) -> DataFrame:
    """The references of (id, text) rows with their windows; a text's hash is its key, as ids repeat.

    Neither the key nor the text is null (an empty text has no citations
    either), so no filter for nulls makes them once more below the joins.
    """
    whole = rows.select("id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = whole.select("id", F.coalesce(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.lit(b"")).alias("key_"), "text")
    refs = citations.extract(keyed.select(F.struct("key_", "id").alias("id"), "text")).select(F.col("id.key_").alias("id"), F.col("id.id").alias("ref_"), "citation_offset")
    # Stored in fact, as the join reads them twice; texts would be matched twice otherwise.
    refs = cut(refs)
    # Dealt by key, which serves equal texts and the join alike.
    return windows.joined(keyed.select(F.col("key_").alias("id"), "text").repartition("id").distinct(), refs, passage=passage)


def stored_windows(v: Views) -> DataFrame:
    """The windows of ``sentence_windows`` for references that are stored, by a join with their texts."""
    return _stored(_wrapped(v), passage=True).select("ref_.*", "citation_offset", "passage_start_offset", "passage_end_offset", "passage")


query()(stored_windows)
ORACLES["stored_windows"] = ORACLES["sentence_windows"]


def stored_footnotes(v: Views) -> DataFrame:
    """The hops of ``footnote_hop`` for references that are stored."""
    body = F.concat(F.lit("Some words here [1] and more. "), F.col("text"), F.lit("\n\n   [1] "), F.col("text"))
    return _stored(v.citation_texts.select("id", body.alias("text"))).select("ref_.*", "citation_offset", "passage_start_offset", "passage_end_offset")


query()(stored_footnotes)
ORACLES["stored_footnotes"] = ORACLES["footnote_hop"]


# --- Windows over whole documents ------------------------------------------------------------------------------------

#: The documents with citations behind their paragraphs, what the extraction finds in them, their paragraphs, and each one's window.
_LAID = rf"""slots AS (SELECT l_orderkey % (SELECT count(*) FROM documents) AS slot, list(text ORDER BY l_orderkey, l_linenumber, manuscript_id, text) AS said FROM cited GROUP BY 1),
  laid AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, coalesce(said, []) AS said FROM documents LEFT JOIN slots ON slot = doc_id % (SELECT count(*) FROM documents)),
  made AS (SELECT doc_id, array_to_string(list_transform(range(len(parts)), lambda i: parts[i + 1] || CASE WHEN len(said) = 0 THEN '' ELSE ' ' || array_to_string(list_transform(range(i, greatest(len(parts), len(said)), len(parts)), lambda j: said[j % len(said) + 1]), ' ') END), chr(10) || chr(10)) AS text FROM laid),
  {_citation_sql("made")},
  refs_found AS (SELECT doc_id, book, book_slug, chapter, TRY_CAST(vs[1] AS INT) AS verse_start, CASE WHEN TRY_CAST(vs[len(vs)] AS INT) <> TRY_CAST(vs[1] AS INT) THEN TRY_CAST(vs[len(vs)] AS INT) END AS verse_end, CAST(place AS INT) AS at FROM numbered JOIN spelled USING (k) WHERE chapter BETWEEN 1 AND chapters),
  split AS (SELECT doc_id, string_split(regexp_replace(text, '(\n[ \t]*\n)', chr(1) || '\1' || chr(1), 'g'), chr(1)) AS parts FROM made),
  paragraphs AS (SELECT doc_id, start, text FROM (SELECT doc_id, i, text, CAST(coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS start
    FROM (SELECT doc_id, unnest(parts) AS text, generate_subscripts(parts, 1) AS i FROM split)) WHERE i % 2 = 1),
  held AS (SELECT r.*, start, text, r.at - start AS inside FROM refs_found r JOIN paragraphs p ON p.doc_id = r.doc_id AND r.at BETWEEN start AND start + length(text)),
  cites AS (SELECT DISTINCT doc_id, start, text FROM held),
  {_sentences_sql("cites", "doc_id, start")},
  counted_ AS (SELECT doc_id, start, count(*) AS n FROM sentences GROUP BY ALL),
  long AS (SELECT s.doc_id, s.start, CAST(g AS INT) AS g, said, n, text FROM sentences s JOIN counted_ USING (doc_id, start) JOIN cites USING (doc_id, start) WHERE n > 10),
  found_ AS (
    SELECT doc_id, start, g, greatest(instr(text, said) - 1, 0) AS low, greatest(instr(text, said) - 1, 0) + length(said) AS upto FROM long WHERE g = 1
    UNION ALL SELECT l.doc_id, l.start, l.g, f.upto + greatest(instr(substr(l.text, f.upto + 1), l.said) - 1, 0), f.upto + greatest(instr(substr(l.text, f.upto + 1), l.said) - 1, 0) + length(l.said)
    FROM found_ f JOIN long l ON l.doc_id = f.doc_id AND l.start = f.start AND l.g = f.g + 1),
  mine AS (SELECT h.doc_id, h.start, h.inside, coalesce(max(g) FILTER (low <= inside), 1) AS g FROM (SELECT DISTINCT doc_id, start, inside FROM held) h JOIN found_ f ON f.doc_id = h.doc_id AND f.start = h.start GROUP BY ALL),
  firsts AS (SELECT m.doc_id, m.start, m.inside, CASE WHEN inside BETWEEN low AND upto THEN m.g ELSE 1 END AS g FROM mine m JOIN found_ f ON f.doc_id = m.doc_id AND f.start = m.start AND f.g = m.g),
  bounds AS (SELECT f.doc_id, f.start, f.inside, greatest(instr(a.text, a.said) - 1, 0) AS low, CASE WHEN instr(reverse(b.text), reverse(b.said)) = 0 THEN length(b.text) ELSE length(b.text) - instr(reverse(b.text), reverse(b.said)) + 1 END AS high
    FROM firsts f JOIN long a ON a.doc_id = f.doc_id AND a.start = f.start AND a.g = least(greatest(f.g - 6, 0), a.n - 10) + 1 JOIN long b ON b.doc_id = f.doc_id AND b.start = f.start AND b.g = a.g + 9),
  placed_ AS (SELECT h.doc_id AS id, book, book_slug, chapter, verse_start, verse_end, h.at AS citation_offset, CAST(h.start + coalesce(low, 0) AS INT) AS passage_start_offset, CAST(h.start + coalesce(high, length(h.text)) AS INT) AS passage_end_offset
    FROM held h LEFT JOIN bounds b ON b.doc_id = h.doc_id AND b.start = h.start AND b.inside = h.inside)"""

ORACLES["passage_windows"] = oracle(f", {_LAID} SELECT * FROM placed_").replace("WITH canon", "WITH RECURSIVE canon", 1)
ORACLES["passage_texts"] = oracle(
    rf""", {_LAID} SELECT 'd' || id || '.txt' AS filename, passage_start_offset, passage_end_offset,
  left(regexp_replace(regexp_replace(substr(text, passage_start_offset + 1, passage_end_offset - passage_start_offset), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '
{{3,}}', chr(10) || chr(10), 'g'), 8000) AS passage
  FROM (SELECT DISTINCT id, passage_start_offset, passage_end_offset FROM placed_) JOIN made ON doc_id = id"""
).replace("WITH canon", "WITH RECURSIVE canon", 1)


def stored_passage_windows(v: Views) -> DataFrame:
    """The windows of ``passage_windows`` for references that are stored, by a join with their texts."""
    rows = _passage_works(v)
    return windows.joined(rows, cut(citations.extract(rows)))


query()(stored_passage_windows)
ORACLES["stored_passage_windows"] = ORACLES["passage_windows"]
