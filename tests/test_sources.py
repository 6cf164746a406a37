import json

from pyspark.sql import functions as F

from versegrid.sources import texts, thml
from versegrid.streaming import ingest

XML = """<?xml version="1.0"?><!DOCTYPE ThML [<!ENTITY x "y">]><ThML><ThML.head><DC.Title>The Title</DC.Title><DC.Creator sub="Author">Last, First (1600-1650)</DC.Creator>
<DC.Date sub="Created">1999</DC.Date><DC.Date sub="Published">1655-01-01</DC.Date><authorID>auth</authorID></ThML.head><body><p>One &amp; &#233; &nbsp;<note>gone <scripRef parsed="|Rom|1|1|0|0">x</scripRef> tail gone</note> kept
<scripRef parsed="|Rom|8|13|8|17" passage="x">Rom. 8</scripRef><!-- said --> more<pb n="3"/> end.<br/></p></b></body>"""


def test_walk():
    got = thml.walk(XML)
    assert got["clean_text"] == "One & é &nbsp; kept\nRom. 8 said  more end." and got["hits"] == [("|Rom|8|13|8|17", got["clean_text"].index("Rom. 8"))]
    assert thml.walk("")["clean_text"] == "" and thml.walk("<a>x<b>y</a>z")["clean_text"] == "xy"


def test_works_of_xml(spark):
    docs = spark.createDataFrame([("c/thml/dir/book.xml", bytearray(XML.encode())), ("c/thml/d2/b2.xml", bytearray(b"<x>"))], "path string, content binary")
    got = {r.path: r for r in thml.works(thml.parse(docs), "u").collect()}
    a, b = got["c/thml/dir/book.xml"], got["c/thml/d2/b2.xml"]
    assert (a.author, a.title, a.year, a.ccel_url, a.filename) == ("First Last", "The Title", 1655, "u/auth/book", "c/thml/dir/book.txt")
    assert (b.author, b.title, b.year, b.ccel_url) == (None, None, None, "u/d2/b2")


def test_text_files(spark, tmp_path):
    rule = "_" * 12
    (tmp_path / "a_b_c.txt").write_bytes((f"{rule}\r\nTitle: T\r\nCreator(s): Last, First\r\n{rule}\r\n" + "x" * 1000).encode() + b"\xff")
    (tmp_path / "mort.txt").write_text("y" * 1001)
    (tmp_path / "tiny.txt").write_text("z")
    rows = texts.read_texts(spark, str(tmp_path))
    got = {r.filename: r.text for r in rows.collect()}
    assert set(got) == {"a_b_c.txt", "mort.txt"} and "\r" not in got["a_b_c.txt"] and got["a_b_c.txt"].endswith("�")
    works = {r.filename: tuple(r)[1:] for r in texts.text_works(rows).collect()}
    assert works["a_b_c.txt"] == ("First Last", "T", None, f"{texts.SITE}/a_b/c") and works["mort.txt"][0] == "John Owen"


def test_links_and_indexes(spark):
    html = '<a class="x" href="/ccel/owen/mort.html">Mort <i>ification</i></a><a href="/ccel/owen/mort.html?x#y">again</a><a href="/ccel/law/call/">Call</a><a href=\'/ccel/a/b/c.html\'>deep</a><a href="z.txt">t</a><a>none</a><a href="/ccel/p/q.html"></a>'
    found = texts.links(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string"))
    assert found.count() == 6
    assert sorted(tuple(r) for r in texts.text_index(found).collect()) == [("owen", "mort", "Mort ification"), ("p", "q", "p/q")]
    assert sorted((r.author_id, r.book_id, r.title) for r in texts.xml_index(found).collect()) == [("law", "call", "Call"), ("owen", "mort", "Mort ification"), ("p", "q", "")]
    assert [r.url for r in texts.text_link(found, "https://s/").collect()] == ["https://s/z.txt"]


def test_manifest_and_downloads(spark, tmp_path):
    rows = [{"author_id": "a", "book_id": "b", "title": "t", "work_url": "u", "status": s, "local_path": p} for s, p in (("downloaded", "x"), ("cached", ""), ("failed", None), ("cached", "y"))]
    (tmp_path / "m.json").write_text(json.dumps(rows))
    assert texts.read_manifest(spark, str(tmp_path / "m.json")).count() == 2
    big = bytearray(b"<" + b"x" * 600)
    c = spark.createDataFrame([(1, 0, "u0", 404, big), (1, 1, "u1", 200, bytearray(b"<small")), (1, 2, "u2", 200, big), (1, 3, "u3", 200, big)], "work int, pos int, url string, status int, content binary")
    assert [tuple(r) for r in texts.first_download(c).collect()] == [(1, "u2")]


def test_verses_and_packing(spark):
    docs = spark.createDataFrame([(json.dumps({"book": "Genesis", "chapters": [{"chapter": "1", "verses": [{"verse": "1", "text": " In "}, {"verse": "2", "text": "b"}]}]}),), ('{"book": "Nope", "chapters": []}',), ("broken",)], "value string")
    verses = texts.verse_texts(docs)
    assert sorted(tuple(r) for r in verses.collect()) == [("genesis", 1, 1, "In"), ("genesis", 1, 2, "b")]
    back = texts.unpacked(texts.packed(verses, F.col("slug"))).collect()
    assert {json.loads(r.value)["text"] for r in back} == {"In", "b"}


def test_stream_replaces_reparsed_texts(spark, tmp_path):
    source, store, checkpoint = (str(tmp_path / x) for x in ("in", "store", "cp"))
    say = lambda *rows: spark.createDataFrame(rows, "filename string, text string").write.mode("append").parquet(source)
    say(("a.txt", "Rom. 8. 1 and Gen. 1. 1"), ("b.txt", "Jude 1"))
    ingest.start(spark, source, store, checkpoint).awaitTermination()
    assert sorted((r.filename, r.book_slug) for r in ingest.current(spark, store).collect()) == [("a.txt", "genesis"), ("a.txt", "romans"), ("b.txt", "jude")]
    say(("a.txt", "nothing now"), ("b.txt", "Jude 1 and Rev. 1"))
    ingest.start(spark, source, store, checkpoint).awaitTermination()
    assert sorted((r.filename, r.book_slug) for r in ingest.current(spark, store).collect()) == [("b.txt", "jude"), ("b.txt", "revelation")]
