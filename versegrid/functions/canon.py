"""The book dimension, abbreviations, groups and numerals."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Books in canonical order, each with its slug, chapters and abbreviations.
_BOOKS = """
Genesis | genesis | 50 | gen, gn
Exodus | exodus | 40 | exod, exo
Leviticus | leviticus | 27 | lev, lv
Numbers | numbers | 36 | num, numb
Deuteronomy | deuteronomy | 34 | deut, deu, dt
Joshua | joshua | 24 | josh, jos
Judges | judges | 21 | judg, jdg, jdgs
Ruth | ruth | 4 | rth
1 Samuel | 1-samuel | 31 | 1 sam, 1sam, 1 sa, 1sa, i sam, i sa
2 Samuel | 2-samuel | 24 | 2 sam, 2sam, 2 sa, 2sa, ii sam, ii sa
1 Kings | 1-kings | 22 | 1 kgs, 1kgs, 1 ki, 1ki, i kgs, i ki
2 Kings | 2-kings | 25 | 2 kgs, 2kgs, 2 ki, 2ki, ii kgs, ii ki
1 Chronicles | 1-chronicles | 29 | 1 chr, 1chr, 1 chron, 1chron, i chr, i chron
2 Chronicles | 2-chronicles | 36 | 2 chr, 2chr, 2 chron, 2chron, ii chr, ii chron
Ezra | ezra | 10 | ezr
Nehemiah | nehemiah | 13 | neh
Esther | esther | 10 | esth, est
Job | job | 42 | 
Psalms | psalms | 150 | ps, pss, psa, psalm
Proverbs | proverbs | 31 | prov, pro, prv
Ecclesiastes | ecclesiastes | 12 | eccl, eccles, ecc, qoh, qoheleth
Song of Solomon | song-of-solomon | 8 | song of sol, song of songs, canticles, cant
Isaiah | isaiah | 66 | isa
Jeremiah | jeremiah | 52 | jer, jr
Lamentations | lamentations | 5 | lam
Ezekiel | ezekiel | 48 | ezek, ezk
Daniel | daniel | 12 | dan, dn
Hosea | hosea | 14 | hos
Joel | joel | 3 | 
Amos | amos | 9 | amo
Obadiah | obadiah | 1 | obad, oba
Jonah | jonah | 4 | jon, jnh
Micah | micah | 7 | mic
Nahum | nahum | 3 | nah
Habakkuk | habakkuk | 3 | hab
Zephaniah | zephaniah | 3 | zeph, zep
Haggai | haggai | 2 | hag
Zechariah | zechariah | 14 | zech, zec
Malachi | malachi | 4 | mal
Tobit | tobit | 14 | tob
Judith | judith | 16 | jdt
1 Maccabees | 1-maccabees | 16 | 1 macc, 1macc, 1 mac, 1mac, i macc, i mac, 1 m
2 Maccabees | 2-maccabees | 15 | 2 macc, 2macc, 2 mac, 2mac, ii macc, ii mac
3 Maccabees | 3-maccabees | 7 | 3 macc, 3macc, 3 mac, 3mac, iii macc, iii mac
4 Maccabees | 4-maccabees | 18 | 4 macc, 4macc, 4 mac, 4mac, iv macc, iv mac
Wisdom of Solomon | wisdom | 19 | wis, wisd, wisdom of sol, wisdom
Sirach | sirach | 51 | sir, ecclus, ecclesiasticus
Baruch | baruch | 6 | bar
Letter of Jeremiah | letter-of-jeremiah | 1 | let jer, ep jer, epistle of jer
Prayer of Azariah | prayer-of-azariah | 1 | pr azar, sg three, song of three
Susanna | susanna | 1 | 
Bel and the Dragon | bel | 1 | bel, bel and dragon
Prayer of Manasseh | prayer-of-manasseh | 1 | pr man, prayer of man
1 Esdras | 1-esdras | 9 | 1 esd, 1esd, i esd, 3 ezra
2 Esdras | 2-esdras | 16 | 2 esd, 2esd, ii esd, 4 ezra
Matthew | matthew | 28 | matt, mat, mt
Mark | mark | 16 | mar, mrk, mk
Luke | luke | 24 | luk, lk
John | john | 21 | joh, jhn, jn
Acts | acts | 28 | act
Romans | romans | 16 | rom, ro, rm
1 Corinthians | 1-corinthians | 16 | 1 cor, 1cor, i cor, 1 co, 1co
2 Corinthians | 2-corinthians | 13 | 2 cor, 2cor, ii cor, 2 co, 2co
Galatians | galatians | 6 | gal, ga
Ephesians | ephesians | 6 | eph, ephes
Philippians | philippians | 4 | phil, php, pp
Colossians | colossians | 4 | col
1 Thessalonians | 1-thessalonians | 5 | 1 thess, 1thess, 1 thes, 1thes, i thess, i thes, 1 th
2 Thessalonians | 2-thessalonians | 3 | 2 thess, 2thess, 2 thes, 2thes, ii thess, ii thes, 2 th
1 Timothy | 1-timothy | 6 | 1 tim, 1tim, i tim, 1 ti, 1ti
2 Timothy | 2-timothy | 4 | 2 tim, 2tim, ii tim, 2 ti, 2ti
Titus | titus | 3 | tit, ti
Philemon | philemon | 1 | phlm, phm, philem
Hebrews | hebrews | 13 | heb
James | james | 5 | jas, jam, jm
1 Peter | 1-peter | 5 | 1 pet, 1pet, 1 pe, 1pe, i pet, i pe, 1 pt, 1pt
2 Peter | 2-peter | 3 | 2 pet, 2pet, 2 pe, 2pe, ii pet, ii pe, 2 pt, 2pt
1 John | 1-john | 5 | 1 john, 1john, 1 jn, 1jn, i john, i jn, 1 jo, 1jo
2 John | 2-john | 1 | 2 john, 2john, 2 jn, 2jn, ii john, ii jn
3 John | 3-john | 1 | 3 john, 3john, 3 jn, 3jn, iii john, iii jn
Jude | jude | 1 | jud
Revelation | revelation | 22 | rev, the revelation, apocalypse, apoc
"""
#: Display groups by the first book of each, in the order of the books; the middle part is one group.
_GROUP_STARTS = {
    "genesis": "Pentateuch", "joshua": "Historical", "job": "Poetic", "isaiah": "Maj. Prophets", "hosea": "Min. Prophets",
    "tobit": "Deuterocanon", "matthew": "Gospels", "acts": "Acts & Epistles", "revelation": "Revelation",
}
#: Further names in the parsed attribute of annotated XML.
_MORE_NAMES = {"psalm": "psalms", "song of songs": "song-of-solomon", "canticle of canticles": "song-of-solomon", "revelations": "revelation", "apocalypse": "revelation"}
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


@dataclass(frozen=True)
class Book:
    name: str
    slug: str
    order: int
    chapters: int
    abbrevs: tuple[str, ...]
    group: str
    group_order: int


@lru_cache(maxsize=1)
def books() -> tuple[Book, ...]:
    out, group, group_order = [], "", 0
    for order, line in enumerate(_BOOKS.strip().split("\n"), 1):
        name, slug, chapters, short = (x.strip() for x in line.split("|"))
        if slug in _GROUP_STARTS:
            group, group_order = _GROUP_STARTS[slug], group_order + 1
        out.append(Book(name, slug, order, int(chapters), tuple(a.strip() for a in short.split(",") if a.strip()), group, group_order))
    return tuple(out)


@lru_cache(maxsize=1)
def abbreviations() -> dict[str, Book]:
    """Every abbreviation and lower-case name, longest first."""
    known = {key: b for b in books() for key in (*b.abbrevs, b.name.lower())}
    return dict(sorted(known.items(), key=lambda kv: -len(kv[0])))


@lru_cache(maxsize=1)
def attribute_names() -> dict[str, Book]:
    """Names in parsed attributes: names, slugs and variants come before abbreviations."""
    by_slug = {b.slug: b for b in books()}
    known = {k: b for b in books() for k in (b.name.lower(), b.slug)} | {k: by_slug[s] for k, s in _MORE_NAMES.items()}
    return {**abbreviations(), **known}


CANON_SCHEMA = "name string, slug string, book_order int, chapters int, first_abbrev string, book_group string, group_order int"


def canon(spark: SparkSession) -> DataFrame:
    """One row a book (82 rows: a bounded side to broadcast)."""
    return spark.createDataFrame([(b.name, b.slug, b.order, b.chapters, b.abbrevs[0] if b.abbrevs else b.name.lower(), b.group, b.group_order) for b in books()], CANON_SCHEMA)


def names(spark: SparkSession, attribute: bool = False) -> DataFrame:
    """(key, slug, name, chapters) of every known way to write a book."""
    known = attribute_names() if attribute else abbreviations()
    return spark.createDataFrame([(k, b.slug, b.name, b.chapters) for k, b in known.items()], "key string, slug string, book string, chapters int")


def roman_to_int(text: Column) -> Column:
    """Additive-subtractive value from right to left, whatever the order of the numerals; null for other characters."""
    s = F.upper(F.trim(text))
    value = F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])
    digits = F.transform(F.filter(F.split(F.reverse(s), ""), lambda c: c != ""), lambda c: F.element_at(value, c))
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("prev"))
    done = F.aggregate(digits, zero, lambda acc, v: F.struct((acc["total"] + F.when(v < acc["prev"], -v).otherwise(v)).alias("total"), v.alias("prev")))
    return F.when(is_roman(text), done["total"])


def is_roman(text: Column) -> Column:
    """Whether a text is written in the letters of numerals alone, in any order."""
    return F.coalesce(F.upper(F.trim(text)).rlike("^[IVXLCDM]+$"), F.lit(False))


def int_to_roman(number: Column) -> Column:
    """Lower-case numeral: a sign for each hundred (nothing above 100 has one of its own), then those of the tens and of the ones."""
    n = number.cast("int")
    digit = lambda signs, at: F.get(F.array(*[F.lit(s) for s in signs.split(",")]), at)
    tens, ones = F.floor(n / 10).cast("int") % 10, n % 10
    out = F.concat(F.repeat(F.lit("c"), F.floor(n / 100).cast("int")), digit(",x,xx,xxx,xl,l,lx,lxx,lxxx,xc", tens), digit(",i,ii,iii,iv,v,vi,vii,viii,ix", ones))
    return F.when(number > 0, out).otherwise(F.lit(""))
