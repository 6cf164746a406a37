"""Citation extraction with code-point offsets, natively, and its parts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import abbreviations, canon, names, roman_to_int
from ..functions.scalars import located, strip, unmarked

# Fixed patterns: the parts of a citation.
_PREFIX = r"(?:(?:Saint|St\.?)\s+)?"
_CHAPTER = r"[ivxlcdm]+|\d+"
_VERSES = r"\d+(?:\s*[-–]\s*\d+)?(?:\s*,\s*\d+)*"
_BETWEEN = r"[\s.:]+"


def letter_tree(words: list[str], said=str) -> str:
    """A pattern of the words that tries longer ones first; ``said`` is the pattern of a letter.

    Words that match at one place are prefixes of each other, so a tree of
    letters with greedy rests tries them in the same order as an alternation
    sorted by length, but looks at each letter of the text once.
    """
    tree: dict = {}
    for word in words:
        at = tree
        for letter in word:
            at = at.setdefault(letter, {})
        at[""] = {}

    def write(at: dict) -> str:
        rests = [said(letter) + write(below) for letter, below in sorted(at.items()) if letter]
        if not rests:
            return ""
        whole = rests[0] if len(rests) == 1 and "" not in at else f"(?:{'|'.join(rests)})"
        return whole + "?" if "" in at else whole

    return write(tree)


#: Letters beyond ASCII that are one of ASCII's in either case.
_LIKE = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def _either(letter: str) -> str:
    """A letter in either case as a class, which is one look where a pattern's flag folds each letter of the text."""
    return f"[{letter}{letter.upper()}{_LIKE.get(letter, '')}]" if letter.isalpha() else letter


@lru_cache(maxsize=1)
def pattern() -> str:
    """The citation pattern: group 1 the book, 2 the chapter, 3 the verses; longest book names first."""
    known = list(abbreviations())
    # Most places are passed over by two looks: behind a letter no word begins, and few letters begin a book.
    firsts = "".join(sorted({c for k in known for c in _either(k[0]).strip("[]")}))
    book = rf"(?-iU:(?<![A-Za-z0-9_])(?=[{firsts}]))\b{_PREFIX}(?-iU:{letter_tree(known, _either)})\.?(?=\W|$)"
    return rf"(?iU)({book})(?:{_BETWEEN}({_CHAPTER})(?:{_BETWEEN}({_VERSES}))?)?"


def verse_range(field: Column) -> Column:
    """(start, end) of a verse field: its first number, and its last where that differs."""
    numbers = F.transform(F.regexp_extract_all(F.coalesce(field, F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    first, last = F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(-1))
    return F.struct(first.alias("verse_start"), F.when(last != first, last).alias("verse_end"))


def book_key(raw: Column) -> Column:
    """A matched book as a key of the abbreviations. "Saint" is not stripped, "St" is."""
    s = F.regexp_replace(F.lower(raw), r"(?U)\bst(?:\.?\s+|aint\s+)", "")
    return strip(F.regexp_replace(F.replace(s, F.lit("."), F.lit("")), r"(?U)\s+", " "))


def chapter_number(raw: Column) -> Column:
    return F.coalesce(roman_to_int(raw), raw.try_cast("int"))


#: Columns of a citation.
FOUND = ("book", "book_slug", "chapter", "verse_start", "verse_end", "citation_offset")


def _mentions(text: Column) -> Column:
    """Array of what the pattern finds with a chapter: citation_offset, book_key, chapter, v; one regex pass over the text."""
    found = F.filter(located(unmarked(text), pattern(), 3), lambda m: m["parts"][1] != "")
    return F.transform(found, lambda m: F.struct(m["start"].alias("citation_offset"), book_key(m["parts"][0]).alias("book_key"), chapter_number(m["parts"][1]).alias("chapter"), verse_range(m["parts"][2]).alias("v")))


def mentions(texts: DataFrame, *, key: str = "id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the ``keep`` columns and mentions (array) of each text; a null text has null mentions.

    No filter on the text: it would be pushed below what makes the text, which would then be made twice.
    """
    return texts.select(key, *keep, _mentions(F.col(text)).alias("mentions"))


def resolved(rows: DataFrame) -> DataFrame:
    """Rows of exploded mentions as citations: unknown books and chapters outside of the book go."""
    known = F.broadcast(names(rows.sparkSession).select(F.col("key").alias("book_key"), F.col("slug").alias("book_slug"), "book", "chapters"))
    return rows.where("chapter >= 1").join(known, "book_key").where("chapter <= chapters").select(*[c for c in rows.columns if c not in ("book_key", "v")], "book", "book_slug", "v.verse_start", "v.verse_end")


def extract(texts: DataFrame, *, key: str = "id", text: str = "text") -> DataFrame:
    """One row a citation: key, book, book_slug, chapter, verse_start, verse_end, citation_offset.

    Mentions without a chapter, unknown books and chapters outside of the book go.
    """
    rows = texts.select(key, F.explode(_mentions(F.col(text))).alias("m_")).select(key, "m_.*")
    return resolved(rows).select(key, *FOUND)


def found_in(text: Column) -> Column:
    """Array of the citations of one text, as :func:`extract` finds them; the names of books travel as a map."""
    known = F.create_map(*[x for k, b in abbreviations().items() for x in (F.lit(k), F.struct(F.lit(b.name).alias("book"), F.lit(b.slug).alias("book_slug"), F.lit(b.chapters).alias("chapters")))])
    told = F.transform(_mentions(text), lambda m: F.struct(m["citation_offset"].alias("at"), m["chapter"].alias("chapter"), m["v"].alias("v"), F.try_element_at(known, m["book_key"]).alias("b")))
    fine = F.filter(told, lambda m: m["b"].isNotNull() & m["chapter"].between(1, m["b"]["chapters"]))
    return F.transform(fine, lambda m: F.struct(m["b"]["book"].alias("book"), m["b"]["book_slug"].alias("book_slug"), m["chapter"].alias("chapter"), m["v"]["verse_start"].alias("verse_start"), m["v"]["verse_end"].alias("verse_end"), m["at"].alias("citation_offset")))


def decode_attribute(hits: DataFrame, *, attribute: str = "parsed") -> DataFrame:
    """Rows of ``hits`` times the citations of their ``version|Book|ch|v|ch|v`` segments, cut at semicolons.

    Segments of other than six parts, with an unknown book, a part that is no
    number or a chapter below 1 go; a verse of 0 is none; the second chapter is
    not used, and chapters have no upper bound here.
    """
    segments = hits.where(F.coalesce(F.col(attribute), F.lit("")) != "").withColumn("segment_", F.explode(F.split(attribute, ";")))
    parts = segments.withColumn("p_", F.split(strip(F.col("segment_")), r"\|", -1)).where(F.size("p_") == 6)
    number = lambda i: strip(F.get("p_", F.lit(i))).try_cast("int")
    name = F.lower(strip(F.get("p_", F.lit(1))))
    spaced = F.regexp_replace(name, "^([1-4])([A-Za-z])", "$1 $2")
    known = F.broadcast(names(hits.sparkSession, attribute=True).select("key", "slug", "book"))
    rows = parts.select(*hits.columns, name.alias("n1_"), spaced.alias("n2_"), number(2).alias("chapter"), number(3).alias("v_"), number(5).alias("w_"))
    rows = rows.where("v_ is not null and w_ is not null and chapter >= 1")
    a, b = known.select(F.col("key").alias("n1_"), F.col("slug").alias("s1_"), F.col("book").alias("b1_")), known.select(F.col("key").alias("n2_"), F.col("slug").alias("s2_"), F.col("book").alias("b2_"))
    rows = rows.join(a, "n1_", "left").join(b, "n2_", "left").withColumn("book_slug", F.coalesce("s1_", "s2_")).where("book_slug is not null")
    return rows.select(
        *hits.columns, F.coalesce("b1_", "b2_").alias("book"), "book_slug", "chapter", F.when(F.col("v_") > 0, F.col("v_")).alias("verse_start"),
        F.when((F.col("w_") > 0) & (F.col("w_") != F.col("v_")), F.col("w_")).alias("verse_end"),
    )


def within_canon(refs: DataFrame) -> DataFrame:
    """References whose chapter the book has."""
    c = F.broadcast(canon(refs.sparkSession).select(F.col("slug").alias("book_slug"), "chapters"))
    return refs.join(c, "book_slug").where(F.col("chapter").between(1, F.col("chapters"))).drop("chapters")
