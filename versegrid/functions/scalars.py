"""Scalar normalisations, labels and helpers, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode-aware trimming, as text handling elsewhere expects; Spark's own trim takes spaces alone.
_ENDS = r"(?U)^\s+|\s+$"
#: Honorifics before a given name, and roles that are no given name.
HONORIFIC = r"(?i)^(?:St\.|Saint|Rev\.?|Dr\.?|Sir)[,\s]+"
ROLE = r"(?i)^(?:Archbishop|Bishop|Cardinal|Pope|Abbot|Patriarch|Monk|Presbyter)\s+of\b"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _ENDS, "")


def or_else(value: Column, fallback: str | Column) -> Column:
    """``value``, or the fallback where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(fallback) if isinstance(fallback, str) else fallback)


def header(text: Column) -> Column:
    """What stands between the first two rules of ten or more underscores in the first 4,000 characters; else null."""
    parts = F.split(F.substring(text, 1, 4000), "_{10,}")
    return F.when(F.size(parts) >= 3, parts[1])


def field(head: Column, name: str, any_case: bool = False) -> Column:
    """First value of a header field, trimmed; null without one."""
    flags = "(?dmi)" if any_case else "(?dm)"
    return F.nullif(strip(F.regexp_extract(head, rf"{flags}^\s*{name}:\s*(.+)", 1)), F.lit(""))


def header_year(head: Column) -> Column:
    return F.regexp_extract(field(head, "Print Basis"), r"(?U)\b(1\d{3}|2[01]\d{2})\b", 1).try_cast("int")


def creator(raw: Column) -> Column:
    """A plain author name from "Last, First (dates)" and its kin."""
    s = strip(F.regexp_replace(raw, r"(?U)\s*\([^)]*\)\s*", " "))
    parts = F.split(s, ",", 2)
    last, given = strip(parts[0]), strip(F.get(parts, F.lit(1)))
    given = strip(F.regexp_replace(strip(F.regexp_replace(given, HONORIFIC, "")), "^,+", ""))
    return (
        F.when(raw.isNull(), None)
        .when(F.lower(s).startswith("anon"), F.lit("Anonymous"))
        .when(F.size(parts) == 1, last)
        .when((given == "") | given.rlike(ROLE), last)
        .otherwise(F.concat_ws(" ", given, last))
    )


def header_author(head: Column) -> Column:
    return creator(field(head, r"Creator\(s\)"))


def work_url(stem: Column, site: str) -> Column:
    """``site``/author/work from a file stem that is cut at its last underscore; null without one."""
    return F.when(stem.contains("_"), F.concat(F.lit(site + "/"), F.regexp_extract(stem, "(?s)^(.*)_(.*)$", 1), F.lit("/"), F.regexp_extract(stem, "(?s)^(.*)_(.*)$", 2)))


def subjects(head: Column) -> Column:
    """Lower-case subject tokens of the header's subjects field; empty array without one."""
    raw = field(head, "CCEL Subjects", any_case=True)
    tokens = F.filter(F.transform(F.split(raw, ";"), lambda x: F.lower(strip(x))), lambda x: x != "")
    return F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>"))


def verse_label(start: Column, end: Column) -> Column:
    """null, "13" or "13-17"."""
    single = end.isNull() | (end == start)
    return F.when(start.isNull(), None).when(single, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))


def verse_key(label: Column) -> Column:
    """Leading digits of a label, the label itself without any, ``whole`` for null or empty."""
    return F.coalesce(F.nullif(F.regexp_extract(label, r"^(\d+)", 1), F.lit("")), F.nullif(label, F.lit("")), F.lit("whole"))


def passage_key(filename: Column, start: Column, end: Column) -> Column:
    """Short export key: base name without .txt, start, end. Joins use the full triple instead."""
    base = F.regexp_extract(filename, r"([^/]*?)(?:\.txt)?$", 1)
    return F.concat_ws("_", base, start.cast("string"), end.cast("string"))


def heat(count: Column, most: Column) -> Column:
    """0 for nothing, else 1 to 4 by the share of the most."""
    share = count / most
    return F.when((count == 0) | (most == 0), 0).when(share < 0.15, 1).when(share < 0.40, 2).when(share < 0.70, 3).otherwise(4)


def shortened(text: Column, most: int) -> Column:
    """Texts longer than ``most`` end in an ellipsis in place of what is over."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def preview(text: Column, start: Column | int = 0, size: int = 80) -> Column:
    at = (start if isinstance(start, Column) else F.lit(start)) + 1
    return F.replace(F.substring(text, at, F.lit(size)), F.lit("\n"), F.lit(" "))


def escaped(text: Column) -> Column:
    """HTML-escaped text; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def mentions(term: str, *parts: Column) -> Column:
    """The parts joined by spaces contain the term in any case; an empty term matches all."""
    whole = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    return F.lit(True) if term == "" else F.contains(whole, F.lit(term.lower()))


def reference_label(book: Column, chapter: Column, start: Column, end: Column, width: int = 30) -> Column:
    """"Book ch[:vs[-ve]]" padded, never cut; a verse of 0 counts as none."""
    verse = F.when(start > 0, F.concat(F.lit(":"), start.cast("string"), F.when(end > 0, F.concat(F.lit("-"), end.cast("string"))).otherwise(F.lit("")))).otherwise(F.lit(""))
    label = F.concat(book, F.lit(" "), chapter.cast("string"), verse)
    return F.when(F.length(label) < width, F.rpad(label, width, " ")).otherwise(label)


def bucket_width(span: Column) -> Column:
    """Years of a time bucket by the span of the dated works."""
    return F.when(span < 200, 25).when(span < 500, 50).when(span < 1000, 100).when(span < 2000, 200).otherwise(500)


def bucket(year: Column, width: Column) -> Column:
    return (F.floor(year / width) * width).cast("int")


def percent(part: Column, whole: Column) -> Column:
    return F.floor(100 * part / whole + 0.5).cast("bigint")


def tick_step(span: Column) -> Column:
    """The first of 1, 2, 5, 10 times a power of ten that cuts the span into 2 to 8 parts, else the last."""
    base = F.pow(F.lit(10.0), F.floor(F.log10(span / 5)))
    out = base * 10
    for k in (5, 2, 1):
        parts = span / (base * k)
        out = F.when((parts >= 2) & (parts <= 8), base * k).otherwise(out)
    return out


def marker_radius(refs: Column, most: Column) -> Column:
    return F.least(F.lit(13.0), F.greatest(F.lit(3.0), 3 + refs / most * 10))


#: Lengths that are summed up in one go; a text of n matches costs about n times this, and the square of n over this.
_BLOCK = 128


def once(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _upto(sizes: Column, start: Column) -> Column:
    # An empty array of integers, whose type shows without a cast.
    zero = F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("out"))
    return F.aggregate(sizes, zero, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]


def running_starts(sizes: Column, start: Column) -> Column:
    """``start`` plus the sum of the sizes before each; summed by blocks, so that no array grows with every element of a long one."""
    last = F.greatest(F.ceil(F.size(sizes) / _BLOCK).cast("int"), F.lit(1)) - 1
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)))
    total = lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x)
    return once(blocks, lambda all_: F.flatten(F.zip_with(all_, _upto(F.transform(all_, total), start), _upto)))


def unmarked(text: Column) -> Column:
    """``text`` without the three characters that :func:`located` marks with; each gives way to one of its like."""
    some = F.contains(text, F.lit("\u0001")) | F.contains(text, F.lit("\u0002")) | F.contains(text, F.lit("\u0003"))
    return F.when(some, F.translate(text, "\u0001\u0002\u0003", "\u0004\u0004\u0004")).otherwise(text)


def located(text: Column, regex: str, groups: int = 0) -> Column:
    """Array of (start, parts) of the leftmost non-overlapping matches: start in code points, parts the groups and last the whole.

    One regex pass over an :func:`unmarked` text sets marks around every match;
    between them stand the gaps, so running sums of lengths give the starts.
    """
    fields = "".join(f"${g}\u0002" for g in range(1, groups + 1))
    marked = F.regexp_replace(text, F.lit(regex), F.lit(f"\u0001{fields}$0\u0003"))
    cut = lambda p: F.struct(F.split(F.substring_index(p, "\u0003", 1), "\u0002", -1).alias("parts"), F.length(F.substring_index(p, "\u0003", -1)).alias("gap"))

    def starts(pieces: Column) -> Column:
        found = F.transform(F.slice(pieces, 2, F.size(pieces)), cut)
        sizes = lambda hits: F.transform(hits, lambda h: F.length(h["parts"][groups]) + h["gap"])
        joined = lambda hits: F.zip_with(running_starts(sizes(hits), F.length(pieces[0])), hits, lambda at, h: F.struct(at.alias("start"), h["parts"].alias("parts")))
        return once(found, joined)

    return once(F.split(marked, "\u0001", -1), starts)
