"""First-match-wins classification of works by one multi-pattern pass over each field.

All fragments of a field form one letter tree, which a single pass tries at
every place. What it finds is looked up as a set of bits, one for each rule
that the fragment fulfils; the sets of all fields are united, and the lowest
bit is the first rule that holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import header, once
from ..functions.scalars import subjects as header_subjects
from .citations import letter_tree

# The rules in order. A rule is (category, field, test, values); the first that holds decides.
# Fields: f file name, a author, t title (all lower-case), s subjects, y year.
_EARLY = [
    "augustine", "athanasius", "cassian", "chrysostom", "origen", "jerome", "ambrose", "basil", "gregory", "cyprian", "tertullian", "irenaeus",
    "clement", "eusebius", "lactantius", "hilary", "leo", "cyril", "ephrem", "ignatius", "polycarp", "papias", "dionysius",
]
_MIDDLE = [
    "eckhart", "bonaventure", "bernard", "anselm", "matelda", "aquinas", "guyon", "tauler", "rolle", "hilton", "kempe", "kempis", "fenelon", "law",
]
_REFORMERS = [
    "calvin", "luther", "melanchthon", "zwingli", "knox", "tyndale", "cranmer", "beza", "bucer", "bullinger", "erasmus",
]
_PURITANS = [
    "owen", "baxter", "bunyan", "flavel", "goodwin", "watson", "boston", "manton", "howe", "gurnall", "charnock", "sibbes", "allestree", "mason",
    "rutherford", "mead", "vincent", "swinnock", "love", "edwards", "shepard", "fisher", "arndt",
]
_PREACHERS = [
    "spurgeon", "maclaren", "moody", "whyte", "dods",
]
_SYSTEMATIC = [
    "berkhof", "bavinck", "hodge", "warfield", "turretin", "dabney", "kuyper", "forsyth",
]
_DEFENDERS = [
    "chesterton", "macdonald", "kierkegaard", "plantinga", "lewis", "pascal", "newman", "sayers", "coleridge",
]
_DEVOUT = [
    "murray", "pink", "torrey", "smith", "gordon", "havergal", "underhill", "fenelon", "wesley", "newton", "moule", "orr", "quadrupani", "steele",
    "upham", "pasko", "inge", "oman",
]
RULES: tuple[tuple[str, str, str, list[str]], ...] = (
    ("Patristics", "f", "has", ["anf", "npnf"]),
    ("Biblical Commentary", "f", "has", ["expositor", "commentary"]),
    ("Biblical Commentary", "t", "has", ["expositor", "commentary"]),
    ("Biblical Commentary", "t", "like", [r"^(an? )?exposition of\b"]),
    ("Biblical Commentary", "t", "has", ["word pictures", "bible studies", "synthetic bible"]),
    ("Scripture", "s", "in", ["bibles", "bible"]),
    ("Scripture", "t", "has", ["catechism", "confession of faith", "heidelberg", "westminster", "book of jasher", "book of common prayer", "augsburg confession", "apology of the augsburg", "scottish confession", "scots confession"]),
    ("Patristics", "s", "in", ["early", "early church"]),
    ("Patristics", "y", "below", ["600"]),
    ("Patristics", "a", "has", _EARLY),
    ("Patristics", "t", "has", ["apostolic fathers", "early christian", "early church"]),
    ("Patristics", "t", "saint", ["alexandria", "hippo", "antioch", "carthage", "caesarea"]),
    ("Medieval", "s", "in", ["mysticism"]),
    ("Medieval", "y", "between", ["600", "1499"]),
    ("Medieval", "a", "has", _MIDDLE),
    ("Medieval", "f", "has", ["cloud"]),
    ("Systematic Theology", "a", "has", _SYSTEMATIC),
    ("Systematic Theology", "t", "has", ["systematic theology", "dogmatics", "dogmatic theology"]),
    ("Church History", "s", "in", ["history"]),
    ("Church History", "t", "has", ["history", "historical", "huguenot"]),
    ("Church History", "f", "has", ["history", "huguenot"]),
    ("Church History", "a", "has", ["menno simon"]),
    ("Church History", "t", "like", [r"^(life of|lives of)\b"]),
    ("Church History", "t", "has", ["eirenicon", "primitive christianity", "rise and progress", "american religious movement"]),
    ("Reformation", "a", "has", _REFORMERS),
    ("Reformation", "t", "has", ["institutes", "bondage of the will", "small catechism", "large catechism", "smalcald", "formula of concord", "thirty-nine articles", "confutatio", "pulpit of the reformation"]),
    ("Puritan", "a", "has", _PURITANS),
    ("Sermons", "a", "has", _PREACHERS),
    ("Sermons", "t", "has", ["sermon"]),
    ("Sermons", "f", "has", ["sermon"]),
    ("Apologetics", "a", "has", _DEFENDERS),
    ("Apologetics", "t", "has", ["apologetics", "defence of", "defense of"]),
    ("Devotional", "a", "has", _DEVOUT),
    ("Devotional", "s", "in", ["christian life"]),
    ("Devotional", "t", "has", ["devotion", "prayer", "meditation", "spiritual", "way of peace", "way of holiness", "holy living", "mortification", "imitation", "uniformity", "piety", "the soul of", "waiting on", "with christ", "comfort for", "christian's secret", "kept for", "love enthroned", "plain account of christian"]),
    ("Devotional", "t", "has", ["hymn", "spiritual songs", "sacred songs", "night thoughts", "religious poems", "poetical works", "divine songs"]),
    ("Devotional", "f", "has", ["hymn"]),
    ("Devotional", "t", "has", ["light and peace", "holy life", "in his steps", "to my younger", "comfort against", "sufferings of christ", "maxims of the saints", "meditating on scripture", "reflections on the christian", "quiet talks"]),
    ("Biblical Commentary", "t", "has", ["helps to the study", "revision revised", "genesis to revelation", "notes on the bible", "bible gallery"]),
    ("Medieval", "t", "has", ["eckhart"]),
    ("Church History", "t", "has", ["thomas boston", "psalmody", "william carey"]),
    ("Patristics", "a", "has", ["philo"]),
)
OTHER = "Other"


# Fixed patterns: what a title must show as a whole once one of a rule's fragments is in it. A rule of kind "like" has its
# pattern; its fragment is the words that every match of it holds.
_SAINT = r"(?U)\bst\.?\s+\w+ of \w+"
_HELD = {r"^(an? )?exposition of\b": ["exposition of"], r"^(life of|lives of)\b": ["life of", "lives of"]}


def fragments(field: str) -> dict[str, int]:
    """The fragments of a field, each with the bits of the rules that it speaks for."""
    out: dict[str, int] = {}
    for rule, (_, where, test, values) in enumerate(RULES):
        if where == field:
            for v in [w for x in values for w in _HELD[x]] if test == "like" else values:
                out[v] = out.get(v, 0) | 1 << rule
    # The tree tells the longest fragment at a place, which speaks for those that it starts with too.
    return {w: sum({bit for x, bits in out.items() if w.startswith(x) for bit in _bits(bits)}) for w in out}


def _bits(n: int) -> list[int]:
    return [1 << i for i in range(n.bit_length()) if n >> i & 1]


def _united(found: Column, known: dict[str, int]) -> Column:
    """The union of the bits of an array's values; unknown values have none."""
    bits = F.create_map(*[F.lit(x).cast(t) for w, n in known.items() for x, t in ((w, "string"), (n, "bigint"))])
    return F.aggregate(found, F.lit(0).cast("bigint"), lambda acc, w: acc.bitwiseOR(F.coalesce(F.try_element_at(bits, w), F.lit(0).cast("bigint"))))


def told_by(text: Column, field: str) -> Column:
    """Bits of the rules that a lower-case field speaks for, by one pass over it."""
    known = fragments(field)
    # Looked ahead and not consumed, so that fragments may overlap.
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=({letter_tree(list(known))}))"), F.lit(1))
    return _united(found, known)


def _checked(bits: Column, text: Column, field: str) -> Column:
    """``bits`` without those rules whose pattern the field doesn't show; only where a fragment has set one."""
    for rule, (_, where, test, values) in enumerate(RULES):
        if where == field and test in ("like", "saint"):
            shown = text.rlike(_SAINT if test == "saint" else "|".join(values))
            bits = F.when((bits.bitwiseAND(F.lit(1 << rule)) != 0) & ~shown, bits.bitwiseAND(F.lit(~(1 << rule)))).otherwise(bits)
    return bits


def category(filename: Column, author: Column, title: Column, year: Column, subjects: Column) -> Column:
    """The category by the first rule that holds; null fields hold nothing, and year 0 is no year."""
    low = lambda c: F.coalesce(F.lower(c), F.lit(""))

    def of(field: str, value: Column) -> Column:
        return once(low(value), lambda text: once(told_by(text, field), lambda b: _checked(b, text, field)))

    bits = [of("f", filename), of("a", author), of("t", title)]
    bits.append(_united(F.coalesce(subjects, F.array().cast("array<string>")), fragments("s")))
    known_year = F.coalesce(F.nullif(year, F.lit(0)), F.lit(99999))
    for rule, (_, _, test, values) in enumerate(RULES):
        if test in ("below", "between"):
            holds = known_year < int(values[0]) if test == "below" else known_year.between(int(values[0]), int(values[1]))
            bits.append(F.when(holds, F.lit(1 << rule).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    all_ = bits[0]
    for b in bits[1:]:
        all_ = all_.bitwiseOR(b)
    names = F.array(*[F.lit(r[0]) for r in RULES])
    # The lowest bit alone is a one and as many zeros as rules come before.
    first = lambda b: F.element_at(names, F.length(F.bin(b.bitwiseAND(-b))))
    return once(all_, lambda b: F.when(b == 0, OTHER).otherwise(first(b)))


def subjects_of(texts: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """(filename, subjects) from the headers of (filename, text); a work whose text isn't there has its archived text's."""
    if archived is not None:
        texts = texts.select("filename", "text").unionByName(archived.join(texts.select("filename"), "filename", "left_anti").select("filename", "text"))
    return texts.select("filename", header_subjects(header(F.col("text"))).alias("subjects"))


def categorise(works: DataFrame, subjects: DataFrame | None = None) -> DataFrame:
    """``works`` with their category; subjects by filename where they are known."""
    if subjects is None:
        joined = works.withColumn("subjects", F.array().cast("array<string>"))
    else:
        joined = works.join(subjects.select("filename", "subjects"), "filename", "left")
    return joined.withColumn("category", category(F.col("filename"), F.col("author"), F.col("title"), F.col("year"), F.col("subjects"))).drop("subjects")
