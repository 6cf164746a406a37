"""Marking the sentence of a passage that holds a citation, natively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.canon import int_to_roman
from ..functions.scalars import escaped, once, strip, unmarked

# Fixed patterns: a sentence starts behind a stop that a capital, quote or bracket follows, or behind a blank line;
# it ends with such a stop, closing quotes apart, with the text's last stop, or with a blank line.
_NEXT = r'\s+[A-Z"(\[]'
_UPTO_START = rf"(?sU)^(.*(?:(?<=\n\n)|(?<=^\n)|(?<=[.!?])(?={_NEXT})))"
_UPTO_END = rf"""(?sU)^(.*?(?:\n\n|[.!?](?=["')\]]*(?:{_NEXT}|\s*\z))))"""


def _reference(chapter: Column, verse_key: Column) -> Column:
    """The pattern of ``chapter . verse`` in either numerals; null where the key holds no verse."""
    verse = strip(F.split(F.coalesce(verse_key, F.lit("")), "[-,]", -1)[0])
    return F.when(verse.rlike("^[0-9]+$"), F.concat(F.lit("(?iU)(?:"), chapter.cast("string"), F.lit("|"), int_to_roman(chapter), F.lit(r")\s*[.:\s]+"), verse, F.lit(r"\b")))


def highlight_passage(text: Column, chapter: Column, verse_key: Column) -> Column:
    """Escaped text with the sentence around the first ``chapter . verse`` in a mark; unmarked where there is none."""
    plain = escaped(text)

    def marked(pieces: Column) -> Column:
        # The pieces tell lengths alone; the text itself is cut, whatever characters it has.
        before, hit = F.left(text, F.length(pieces[0])), F.substring(text, F.length(pieces[0]) + 1, F.length(pieces[1]))
        # A start can only be told with the character that follows it, the hit's first at the latest.
        start = F.length(F.regexp_extract(F.concat(before, F.left(hit, F.lit(1))), _UPTO_START, 1))
        after = F.substring(text, F.length(pieces[0]) + F.length(pieces[1]) + 1, F.length(text))

        def put(x: Column) -> Column:
            lead = F.substring(x["before"], x["start"] + 1, F.length(x["before"]))
            skipped = x["start"] + F.length(lead) - F.length(F.ltrim(lead))
            size = F.when(x["told"] != "", F.length(x["told"])).otherwise(F.length(x["after"]))
            inside = F.concat(F.substring(x["before"], skipped + 1, F.length(x["before"])), x["hit"], F.left(x["after"], size))
            return F.concat(escaped(F.left(x["before"], skipped)), F.lit("<mark>"), escaped(inside), F.lit("</mark>"), escaped(F.substring(x["after"], size + 1, F.length(x["after"]))))

        return once(F.struct(before.alias("before"), hit.alias("hit"), start.alias("start"), after.alias("after"), F.regexp_extract(after, _UPTO_END, 1).alias("told")), put)

    def found(regex: Column) -> Column:
        # One pass of the row's own pattern; the first two marks stand around the first match.
        pieces = F.split(F.regexp_replace(unmarked(text), regex, F.lit("\u0001$0\u0001")), "\u0001", 3)
        return once(pieces, lambda p: F.when(F.size(p) > 1, marked(p)))

    return F.coalesce(once(_reference(chapter, verse_key), found), plain)
