"""Main text of web pages, with a host's repeated token strings as evidence.

A page is read into blocks of text in page order. Where the page marks its
article, the article's blocks are the text, less what sits in menus, asides,
forms and the like inside it, and less blocks that most pages of the host
repeat. A container inside whose name has such a word beside words of its own
is only suspect: its blocks go where links fill them or the host repeats them.
Elsewhere the blocks outside of such containers, those in main zones
first, are uncertain, and the host's repeated strings decide: the token streams
of all its pages are laid out as suffixes, cut to their first GRAM tokens and
dealt by them, and strings that distinct pages share are boilerplate. A block
mostly covered by them goes, unique runs stay. A main zone that has more words
left than the articles is the text with them.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import bitmap, cut

#: Tokens of a repeated string, pages of distinct streams that must share it, and the covered share from which a block goes.
GRAM, PAGES, COVERED = 6, 3, 0.8
#: An article's block goes if this share of the host's distinct pages, and so many of them, have it in their articles.
MOST, MOST_PAGES = 0.5, 10
#: Bytes of repeated strings of pages up to which they are broadcast to the pages; beyond it the blocks of the pages that have such strings are shuffled to meet them.
BROADCAST = 16 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select title".split())
#: Elements that hold no article text.
CHROME = frozenset("nav footer aside form button menu dialog head".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
#: Words in class or id of containers without article text: outside of articles whatever stands beside them, inside where only words of layout do.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sidebar nav navbar navigation breadcrumb breadcrumbs footer "
    "gdpr newsletter subscribe comment comments respond disqus pagination pager masthead".split()
)
#: Words that also name things that articles are about; they tell only beside each other and beside words of layout.
DOUBTFUL = frozenset("promo promotion banner menu cookie cookies consent notice alert related share sharing social popup modal login signup widget toolbar".split())
LAYOUT = frozenset(
    "area article bar block body bottom box button buttons center clearfix col column component container content count dark default desktop entry first fixed flex float fluid footer form free global google grid "
    "group header hidden icon icons in inline inner item items js label last lead leaderboard left lg light link links list main md message mid mobile module more mpu native now our outer overlay page panel "
    "placeholder post posts primary reader rectangle region reply right row secondary section site skyscraper slot sm small standard sticky template text the theme thread title top unit up us user visitor "
    "wide wp wrap wrapper xl xs your is".split()
)
#: Of these, the ones that tell on an article element itself; and words of modifiers that only speak of such containers.
ARTICLE_NOISE = frozenset("ad ads advert adverts advertisement sponsored promo comment comments related".split())
MODIFIERS = frozenset("has with no without".split())
OWN = frozenset("article post entry content story".split())
CONTENT = frozenset("articlebody content maincontent postcontent entrycontent storybody post entry story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

#: Zones: an article; a main part; neither; chrome; the title of a main part outside of its articles; containers in either that only their class speaks against;
#: containers in an article whose class has words against it beside others.
ARTICLE, MAIN, OTHER, CHROME_TEXT, TITLE, DOUBT, SUSPECT = range(7)
#: Share of a suspect block's characters that are links, from which it is none of the article's.
LINKED = 0.5


def _words(value: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(value)}


def _unknown(words: set[str]) -> set[str]:
    """Words that are neither of layout nor against article text."""
    return {w for w in words - NOISE - DOUBTFUL - LAYOUT if not w.isdigit() and len(w) > 1}


def _told(value: str, name: str) -> int:
    """What a class or id says: 2, a container without article text; 1, perhaps one, as other words stand beside; 0, nothing of the kind."""
    parts = [w for p in value.split() if not (w := _words(p)) & MODIFIERS]
    every = set().union(*parts)
    if every & NOISE:
        # Sections are parts of a document, which may well be about the year 70.
        return 1 if _unknown(every) or name == "section" and every & NOISE <= {"ad", "ads"} else 2
    return 2 if any(w & DOUBTFUL and not _unknown(w) for w in parts) else 0


def _kind(name: str, attrs: str, inside: bool) -> int | None:
    """What an element makes of its content: chrome, doubtful, suspect, article or main; None leaves it."""
    if name in CHROME:
        return CHROME_TEXT
    role, noisy, strong, content, head = "", 0, False, False, False
    if attrs and "=" in attrs:
        for key, a, b, c in _ATTR.findall(attrs):
            value, key = a or b or c, key.lower()
            if key == "role":
                role = value.strip().lower()
                continue
            told = _told(value, name)
            noisy = max(noisy, told)
            for part in value.split():
                words = _words(part)
                content |= re.sub(r"[^a-z]", "", part.lower()) in CONTENT
                strong |= told == 2 and bool(words & ARTICLE_NOISE) and not words & MODIFIERS
                head |= "header" in words and not words & OWN
    if head and not inside:
        noisy = 2
    if role in ROLES or strong:
        return CHROME_TEXT
    if noisy and name not in ("article", "body", "html", "main"):
        return (DOUBT if noisy == 2 else SUSPECT) if inside else CHROME_TEXT
    if name == "header" and not inside:
        return CHROME_TEXT
    if name == "article" or role == "article":
        return ARTICLE
    if name == "main" or role == "main" or content:
        return MAIN
    return None


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) of the page's blocks in order; character references decoded between tags, white space single."""
    out: list[tuple[int, str]] = []
    run: list[str] = []
    stack: list[tuple[str, int | None]] = []
    zones = [0] * 7
    linked, link = 0, False

    def zone(share: float) -> int:
        if zones[SUSPECT] and share >= LINKED:
            return CHROME_TEXT
        for kind in (CHROME_TEXT, DOUBT, ARTICLE):
            if zones[kind]:
                return SUSPECT if kind == ARTICLE and zones[SUSPECT] else kind
        return TITLE if zones[MAIN] and zones[TITLE] else MAIN if zones[MAIN] else OTHER

    def end():
        nonlocal linked, link
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append((zone(linked / len(text)), text))
            run.clear()
        linked, link = 0, False

    def say(text: str):
        nonlocal linked
        run.append(text)
        linked += len(text.strip()) * link

    def pop(to: int):
        end()
        while len(stack) > to:
            kind = stack.pop()[1]
            if kind is not None:
                zones[kind] -= 1

    def close(names, within=()):
        """Close the innermost open element of these names, unless one of ``within`` is further in."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                if stack[i][0] in BLOCKS or any(kind is not None for _, kind in stack[i:]):
                    pop(i)
                else:
                    del stack[i]
                return
            if stack[i][0] in within:
                return

    at, html = 0, html or ""
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            say(unescape(html[at : m.start()]))
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"]:
                run.append(" ")
            continue
        name = name.lower()
        link = not m["close"] if name == "a" else link
        if m["close"]:
            if name in BLOCKS:
                end()
            elif name in ("td", "th"):
                run.append(" ")
            close((name,))
            continue
        if name == "br" or name in ("td", "th"):
            run.append(" ")
        if name in BLOCKS:
            end()
            close(("p",), ("div", "article", "section", "main", "body", "td", "li", "blockquote"))
            if name == "li":
                close(("li",), ("ul", "ol", "menu"))
        if name in VOID or (m["attrs"] or "").endswith("/"):
            continue
        kind = TITLE if name == "h1" else _kind(name, m["attrs"], bool(zones[ARTICLE] or zones[MAIN]))
        if kind is not None:
            end()
            zones[kind] += 1
        stack.append((name, kind))
    say(unescape(html[at:]))
    end()
    return out


OF_ARTICLE = {ARTICLE, SUSPECT}


def certain(found: list[tuple[int, str]]) -> list[str] | None:
    """The article's blocks where the page marks it, [] for a page without text, None where it is uncertain.

    A main part's title before its articles belongs to them if they have none;
    what only its class speaks against is better than no article.
    """
    zones = {z for z, _ in found}
    if zones & OF_ARTICLE:
        first = next(i for i, (z, _) in enumerate(found) if z in OF_ARTICLE)
        return [t for i, (z, t) in enumerate(found) if z in OF_ARTICLE or z == TITLE and i < first]
    for zone in ({MAIN, TITLE}, {DOUBT}):
        if zones & zone:
            return [t for z, t in found if z in zone]
    return None if OTHER in zones else []


def settled(found: list[tuple[int, str]]) -> list[str] | None:
    """The text that needs no judgement by repeated strings; None where there are blocks of a main zone, suspect ones, or only uncertain ones."""
    return None if any(z in (MAIN, SUSPECT) for z, _ in found) else certain(found)


def judged(found: list[tuple[int, str]], known: set[int], size: int = GRAM, covered: float = COVERED) -> list[str]:
    """The text of a page, given the repeated strings of its host: of all pages for articles' blocks, of a few for others."""
    if settled(found) is not None:
        kept = [(z, t) for z, t in found if z != ARTICLE or whole_block(t) not in known]
        return certain(kept if any(z == ARTICLE for z, _ in kept) else found)
    zones = {z for z, _ in found}
    zone = MAIN if MAIN in zones else None if zones & OF_ARTICLE else OTHER
    fresh = [(z == zone or z == TITLE) and _covered(t, known, size) < covered for z, t in found]
    words = lambda keep: sum(len(t.split()) for (_, t), k in zip(found, keep, strict=True) if k)
    article = [z == ARTICLE and whole_block(t) not in known or z == SUSPECT and _covered(t, known, size) < covered for z, t in found]
    if not any(article):
        article = [z in OF_ARTICLE for z, _ in found]
    if any(article):
        title = [z == TITLE and f and not any(article[:i]) for i, ((z, _), f) in enumerate(zip(found, fresh, strict=True))]
        only = words(article) >= words([f and z != TITLE for f, (z, _) in zip(fresh, found, strict=True)])
        fresh = [a or (t if only else f) for a, t, f in zip(article, title, fresh, strict=True)]
    elif not any(fresh):
        fresh = [z == zone for z, _ in found]
    return [t for (_, t), k in zip(found, fresh, strict=True) if k]


def whole_block(text: str) -> int:
    """Hash of a block as a whole, apart from those of its strings."""
    return int.from_bytes(blake2b(text.encode(), digest_size=8, person=b"block").digest(), "little", signed=True)


def suffixes(text: str, size: int = GRAM) -> list[int]:
    """Hashes of the first ``size`` tokens of each suffix of a block; a shorter block is one."""
    tokens = text.split()
    heads = [" ".join(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))]
    return [int.from_bytes(blake2b(h.encode(), digest_size=8).digest(), "little", signed=True) for h in heads]


def _covered(text: str, known: set[int], size: int) -> float:
    tokens = text.split()
    marks = [False] * len(tokens)
    for i, h in enumerate(suffixes(text, size)):
        if h in known:
            marks[i : i + size] = [True] * len(marks[i : i + size])
    return sum(marks) / len(marks)


def _streams(size: int):
    """Of each page with text: its stream's hash, suffixes outside of articles, articles' blocks, and whether it is uncertain."""

    def run(batches):
        for batch in batches:
            rows, heads, whole, stream, unsure = [], [], [], [], []
            for i, html in enumerate(batch.column("html").to_pylist()):
                found = blocks(html)
                if not found:
                    continue
                rows.append(i)
                heads.append(sorted({h for z, t in found if z != ARTICLE for h in suffixes(t, size)}))
                whole.append(sorted({whole_block(t) for z, t in found if z == ARTICLE}))
                stream.append(whole_block("\n".join(t for _, t in found)))
                unsure.append(settled(found) is None)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(at), batch.column("host").take(at).cast(pa.string()), pa.array(stream, pa.int64()), pa.array(unsure, pa.bool_()), pa.array(heads, pa.list_(pa.int64())), pa.array(whole, pa.list_(pa.int64()))],
                names=["row", "host", "stream", "unsure", "heads", "whole"],
            )

    return run


def _parsed(batches):
    """Each page's blocks that may be its text; what can't be, and the markup, is left behind before anything is shuffled."""
    for batch in batches:
        zones, texts = [], []
        for html in batch.column("html").to_pylist():
            found = [(z, t) for z, t in blocks(html) if z != CHROME_TEXT]
            zones.append([z for z, _ in found])
            texts.append([t for _, t in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url").cast(pa.string()), batch.column("row"), pa.array(zones, pa.list_(pa.int8())), pa.array(texts, pa.list_(pa.string()))],
            names=["page_id", "url", "row", "zones", "texts"],
        )


def _texts(size: int, covered: float):
    def run(batches):
        for batch in batches:
            zones, blocks_, known = (batch.column(c).to_pylist() for c in ("zones", "texts", "known"))
            texts = ["\n".join(judged(list(zip(z, t, strict=True)), set(k or ()), size, covered)) for z, t, k in zip(zones, blocks_, known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", size: int = GRAM, least_pages: int = PAGES, covered: float = COVERED, most: float = MOST, most_pages: int = MOST_PAGES) -> DataFrame:
    """page_id, url and text of each page.

    Null or empty html gives an empty text. Blocks of marked articles stay,
    also where pages share passages, unless ``most`` of the host's distinct
    pages have them; blocks of main zones and uncertain ones are judged by what
    ``least_pages`` share. A page that would lose all of its blocks keeps them.
    Pages with equal texts count once; a null url is a host of its own; at
    equal word counts the article is the text, not the main zone around it;
    repeated rows give repeated results; other columns are ignored. A host is
    never gathered: its suffixes are dealt by their first tokens.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    src = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"), host.alias("host"), F.xxhash64(F.col(url), F.col(html)).alias("row"))
    streams = cut(src.select("row", "host", "html").mapInArrow(_streams(size), "row bigint, host string, stream bigint, unsure boolean, heads array<bigint>, whole array<bigint>"))

    def counted(column: str) -> DataFrame:
        # What distinct pages share; a page's own repeats are gone already.
        each = streams.select("host", "stream", F.explode(column).alias("head")).distinct()
        return each.groupBy("host", "head").agg(F.count("*").alias("n"))

    pages_of = streams.select("host", "stream").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    few = counted("heads").where(F.col("n") >= least_pages).select("host", "head")
    many = counted("whole").where(F.col("n") >= most_pages).join(pages_of, "host").where(F.col("n") >= most * F.col("pages")).select("host", "head")
    asked = streams.where("unsure").select("row", "host", F.explode("heads").alias("head")).distinct().join(few, ["host", "head"])
    asked = asked.unionByName(streams.select("row", "host", F.explode("whole").alias("head")).distinct().join(many, ["host", "head"]))
    known = cut(asked.groupBy("row").agg(F.collect_list("head").alias("known")))
    held = known.agg(F.coalesce(F.sum(F.size("known") * 8 + 32), F.lit(0)).alias("n")).first()["n"]
    schema = "page_id bigint, url string, row bigint, zones array<tinyint>, texts array<string>"
    final = lambda told: told.select("page_id", "url", "zones", "texts", "known").mapInArrow(_texts(size, covered), "page_id bigint, url string, text string")
    rows = src.select("page_id", "url", "row", "html")
    if held <= BROADCAST:
        return final(rows.mapInArrow(_parsed, schema).join(F.broadcast(known), "row", "left"))
    # Pages that no repeated string reaches are done where they stand; of the others, blocks alone are shuffled.
    filled, bits = bitmap(known.select("row"), lambda batch: batch.column("row").to_numpy().view(K.U), known.count())
    filter_ = pages.sparkSession.sparkContext.broadcast(filled)

    def those(asked: bool):
        def run(batches):
            for batch in batches:
                here = K.bits_set(filter_.value, batch.column("row").to_numpy().view(K.U), bits)
                yield batch.filter(pa.array(here == asked))

        return rows.mapInArrow(run, rows.schema).mapInArrow(_parsed, schema)

    return final(those(True).join(known, "row", "left")).unionByName(final(those(False).withColumn("known", F.lit(None).cast("array<bigint>"))))


def digest(texts: DataFrame) -> DataFrame:
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
