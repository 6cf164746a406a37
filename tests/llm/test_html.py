import random

import pytest

from versegrid.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site head</header>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div><article><h1>Title &amp;amp; more</h1><p><b>First &lt;b&gt; part.<br><p>Second
  part&nbsp;with  <i>inline</i><b>tags</b></p><aside>side</aside><div class="post-comments"><p>reader says</p></div><form><p>mail</p></form><ul><li>one<li>two</ul><p>a < b &copy; \U0001f600</p></article>
<div id="cookie-notice">cookies</div><footer>&copy; foot</footer></body></html>"""


def test_marked_article():
    got = html.certain(html.blocks(PAGE))
    assert got == ["Title &amp; more", "First <b> part.", "Second part with inlinetags", "one", "two", "a < b © \U0001f600"]


def test_odd_markup():
    assert html.blocks(None) == [] and html.blocks("") == []
    assert html.certain(html.blocks("<article><p>cut off <b>he")) == ["cut off he"]
    assert html.certain(html.blocks("<article><p>x</p><!-- never closed <p>y")) == ["x"]
    assert html.certain(html.blocks("<article><p title='a>b'>x</p><p title=\"unclosed>y</p></article>"))[0] == "x"
    assert html.certain(html.blocks("<main><header><h2>H</h2></header><p>m</p></main><p>o</p>")) == ["H", "m"]
    assert html.certain(html.blocks("<article><nav>n<p>q</article><p>after</p>")) is None
    assert html.certain(html.blocks("<article><table><tr><td>a</td><td>b</td></tr></table></article>")) == ["a b"]
    assert html.certain(html.blocks('<body class="nav-open"><article class="post sidebar-left"><p class="no-sidebar">x</p><article class="comment">c</article></article>')) == ["x"]
    assert len(html.blocks("<div>" * 20_000 + "deep")) == 1


def test_host_boilerplate_decides_uncertain_blocks(spark):
    menu = "Home News Sport Weather Contact and Imprint of this site"
    rows = [(i, f"https://h.example/p{i}", f"<body><div>{menu}</div><div>Unique story number {i} with words w{i} x{i} y{i} z{i} told once</div></body>") for i in range(5)]
    rows += [(10, "https://other.example/", f"<body><div>{menu}</div></body>"), (11, None, None), (12, "u", ""), (3, *rows[3][1:]), (13, "http://h.example/a", PAGE), (14, "http://h.example/b", PAGE), (None, None, "<p>x</p>")]
    df = spark.createDataFrame([(*r, "r", "h") for r in rows], "page_id bigint, url string, html string, row string, host string")
    got = html.digest(html.extract(df)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert all(by[i].text == f"Unique story number {i} with words w{i} x{i} y{i} z{i} told once" for i in range(5))
    assert by[10].text == menu and by[11].text == by[12].text == "" and by[None].text == "x"
    assert by[13].text == by[14].text and by[13].n_chars == len(by[13].text) > 50
    assert html.extract(df.limit(0)).count() == 0


def test_host_boilerplate_decides_in_main_zones(spark):
    notice = "Sign up now for the daily letter of this site and win"
    story = "Unique story number {0} with words w{0} x{0} y{0} z{0} told once"
    rows = [(i, f"https://h.example/p{i}", f"<body><main><p>{notice}</p><p>{story.format(i)}</p><article><p>teaser {i}</p></article></main></body>") for i in range(5)]
    rows += [(10, "https://h.example/a", f"<main><p>{notice}</p><article><p>{story.format(10)}</p></article></main>"), (11, "https://other.example/", f"<main>{notice}</main>")]
    by = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(by[i] == story.format(i) + f"\nteaser {i}" for i in range(5))
    assert by[10] == story.format(10) and by[11] == notice


def test_titles_tables_and_references():
    text = lambda page: html.certain(html.blocks(page))
    assert text("<main><h1>T</h1><p>lead</p><article><p>x</p></article></main>") == ["T", "x"]
    assert text("<main><h1>Site</h1><article><h1>T</h1><p>x</p></article></main>") == ["Site", "T", "x"]
    assert text('<article><section id="related-work"><p>r</p></section><div class="share-price-table"><p>s</p></div><div class="share-buttons">go</div></article>') == ["r", "s"]
    assert text('<article><div class="post-notice">only this</div></article>') == ["only this"]
    assert text('<article><div class="comments">only this</div></article>') == []
    assert text('<article><p>x</p><div class="social-share">go</div><div id="comments">c</div><div class="cookie-recipe">flour</div></article>') == ["x", "flour"]
    assert text("<article><p>AT&<b>amp</b> &#x41;&lt;b&gt;</p></article>") == ["AT&amp A<b>"]


def test_words_of_classes_are_no_proof_inside_an_article():
    text = lambda inner: html.certain(html.blocks(f"<article><p>x</p>{inner}<p>y</p></article>"))
    prose = "<p>The temple fell, and what was written of it is told here.</p>"
    for names in ('section id="ad-70"', 'div class="footer-notes"', 'div class="how-to-respond"', 'div id="comments-on-the-text"', 'div class="sponsor-history"', 'div class="celestial navigation"', 'div class="no-sidebar"', 'section class="AD 70"'):
        assert text(f"<{names}>{prose}</{names.split()[0]}>") == ["x", prose[3:-4], "y"], names
    for names in ('div class="ad"', 'div id="ad-slot-3"', 'div class="comments-area"', 'section class="comments"', 'div class="sidebar primary wide"', 'div id="respond"', 'ul class="breadcrumbs"', 'div class="site-footer"', 'div class="reader comments"'):
        assert text(f"<{names}>{prose}</{names.split()[0]}>") == ["x", "y"], names
    # A suspect part that is all links is a menu, one that quotes a link is not.
    assert text('<ul class="celestial navigation"><li><a href="/a">Stars</a></li><li><a href="/b">Moons</a></li></ul>') == ["x", "y"]
    assert text('<div class="celestial navigation"><p>By the <a href="/a">stars</a> alone they sailed.</p></div>') == ["x", "By the stars alone they sailed.", "y"]


def test_suspect_parts_that_a_host_repeats_go(spark):
    said = "Write to the editors of these pages if you have more to tell of it"
    page = lambda i, own: f"<article><h1>Story {i}</h1><p>Text of {i}</p><div class='how-to-respond'><p>{own}</p></div></article><div>More from here {i}</div>"
    rows = [(i, "https://h.example/", page(i, said)) for i in range(4)] + [(9, "https://h.example/", page(9, "Nine answers in its own words and no others are like them")), (20, "https://o.example/", page(20, said))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {**{i: f"Story {i}\nText of {i}" for i in range(4)}, 9: "Story 9\nText of 9\nNine answers in its own words and no others are like them", 20: f"Story 20\nText of 20\n{said}"}


def test_what_most_pages_repeat_goes_from_articles(spark):
    notice, shared = "Support our journalism today", "A passage that some pages share as it is"
    body = lambda i: f"<article><h1>Story {i}</h1><p>{notice}</p>{f'<p>{shared}</p>' if i % 3 == 0 else ''}<p>Text of {i}</p></article>"
    rows = [(i, f"https://h.example/{i}", body(i)) for i in range(30)] + [(100 + i, f"https://small.example/{i}", body(i)) for i in range(5)] + [(200, "https://h.example/x", f"<article><p>{notice}</p></article>")]
    want = {i: f"Story {i}\n" + (f"{shared}\n" if i % 3 == 0 else "") + f"Text of {i}" for i in range(30)}
    want |= {100 + i: want[i].replace("\n", f"\n{notice}\n", 1) for i in range(5)} | {200: notice}
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in html.extract(df).collect()} == want


def test_joined_and_broadcast_strings_agree(spark, monkeypatch):
    menu = "Home News Sport Weather Contact and Imprint of this site"
    rows = [(i, f"https://h.example/{i % 9}", f"<div>{menu}</div><div>Own words {i} {i} {i} a b c {i}</div>") for i in range(40)] + [(99, "https://h.example/l", f"<div>{menu}</div><p>{'long text ' * 200_000}</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    once = sorted(map(tuple, html.extract(df).collect()))
    monkeypatch.setattr(html, "BROADCAST", -1)
    assert sorted(map(tuple, html.extract(df).collect())) == once and len(once[-1][2]) == 200_000 * 10 - 1 and once[0][2] == "Own words 0 0 0 a b c 0"


def _brute(rows, size=6):
    """Texts of pages by sets of whole strings per host, straight from the definition."""
    host = lambda u: (u or "").split("://")[-1].split("/")[0].lower()
    grams = lambda t: {tuple(t.split()[i : i + size]) for i in range(max(1, len(t.split()) - size + 1))}
    pages = {}
    for _, u, h in rows:
        pages.setdefault(host(u), set()).add(tuple(html.blocks(h)))
    out = []
    for i, u, h in rows:
        mine, others = html.blocks(h), [p for p in pages[host(u)] if p]
        # Pages of equal texts count once.
        distinct = {"\n".join(t for _, t in p): p for p in others}.values()
        shares = lambda found, some: sum(any(found(z, t) for z, t in p) for p in some)  # noqa: E731, B023
        many = {t for z, t in mine if z == html.ARTICLE and (n := shares(lambda y, s, t=t: y == html.ARTICLE and s == t, distinct)) >= 10 and n >= 0.5 * len(distinct)}
        common = {g for z, t in mine if z != html.ARTICLE for g in grams(t) if shares(lambda y, s, g=g: y != html.ARTICLE and g in grams(s), distinct) >= 3}

        def covered(t):
            words = t.split()
            marks = set()
            for a in range(max(1, len(words) - size + 1)):
                if tuple(words[a : a + size]) in common:  # noqa: B023
                    marks |= set(range(a, min(a + size, len(words))))
            return len(marks) / len(words)

        article = [t for z, t in mine if z == html.ARTICLE and t not in many] or [t for z, t in mine if z == html.ARTICLE]
        main = [t for z, t in mine if z == html.MAIN and covered(t) < 0.8]
        other = [t for z, t in mine if z == html.OTHER]
        if article and any(z == html.MAIN for z, _ in mine) and sum(len(t.split()) for t in main) > sum(len(t.split()) for t in article):
            keep = {*article, *main}
            text = [t for z, t in mine if z in (html.ARTICLE, html.MAIN) and t in keep]
        elif article:
            text = [t for z, t in mine if z == html.ARTICLE and t in article]
        elif any(z == html.MAIN for z, _ in mine):
            text = main or [t for z, t in mine if z == html.MAIN]
        else:
            text = [t for t in other if covered(t) < 0.8] or other
        out.append((i, "\n".join(text)))
    return sorted(out)


@pytest.mark.parametrize("most", [html.BROADCAST, -1])
def test_pages_match_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(html, "BROADCAST", most)
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40)) for _ in range(n))
    shared = [say(rng.randrange(3, 25)) for _ in range(8)]
    part = lambda: rng.choice([say(rng.randrange(1, 30)), rng.choice(shared), f"{rng.choice(shared)} {say(2)}"])
    rows = []
    for i in range(140):
        blocks = "".join(f"<p>{part()}</p>" for _ in range(rng.randrange(1, 6)))
        notice = f"<p>{shared[0]}</p>"
        rows.append((i, f"https://h{i % 4}.example/{i}", rng.choice([f"<article>{notice}{blocks}</article><div>{part()}</div>", f"<main>{notice}{blocks}</main>", f"<main><p>{part()}</p><article>{blocks}</article></main>", f"<div>{shared[1]}</div>{blocks}<footer>{part()}</footer>"])))
    rows += [(500, *rows[1][1:]), (501, rows[1][1], None), (502, None, rows[3][2])]
    got = html.digest(html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))).collect()
    want = _brute(rows)
    assert sorted((r.page_id, r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)
    assert sum(shared[0] not in t and shared[0] in h for (_, t), (_, _, h) in zip(want, sorted(rows), strict=True) if h) > 10
