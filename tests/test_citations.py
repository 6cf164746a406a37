import pytest
from pyspark.sql import functions as F

from versegrid.functions.canon import abbreviations, attribute_names, books
from versegrid.operators import citations

CASES = [
    ("Rom. viii. 13", [("romans", 8, 13, None, 0)]), ("Rom.8:13", [("romans", 8, 13, None, 0)]), ("St. John vi. 44", [("john", 6, 44, None, 0)]), ("Saint John vi. 44", []),
    ("1 Cor. 15:10", [("1-corinthians", 15, 10, None, 0)]), ("1\nCor. 15:10", []), ("I Corinthians 3:4", []), ("Gal. v. 16, 17, 2 Cor. 3. 4", [("galatians", 5, 16, 2, 0)]),
    ("Job did", []), ("Mark its", [("mark", 1, None, None, 0)]), ("Psalm concerning", [("psalms", 100, None, None, 0)]), ("1. John iii. 16", [("john", 3, 16, None, 3)]),
    ("Rom. viii. 13–17", [("romans", 8, 13, 17, 0)]), ("Rom. viii 13; ix. 4", [("romans", 8, 13, None, 0)]), ("Rom. viii, 13", [("romans", 8, None, None, 0)]),
    ("Ps. xxvii.", [("psalms", 27, None, None, 0)]), ("Romans", []), ("Mark 5, 6", [("mark", 5, None, None, 0)]), ("Rom. 17. 1", []), ("Rom. 0", []), ("pp. 3", [("philippians", 3, None, None, 0)]),
    ("Gen 1:1-1", [("genesis", 1, 1, None, 0)]), ("General 3", []), ("\U0001f600é Jude 1 and\nRev. 22:21", [("jude", 1, None, None, 3), ("revelation", 22, 21, None, 14)]), ("", []), (None, []),
]


def test_literal_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string")
    got = {}
    for r in citations.extract(df).collect():
        got.setdefault(r.id, []).append((r.book_slug, r.chapter, r.verse_start, r.verse_end, r.citation_offset))
    for i, (text, want) in enumerate(CASES):
        assert sorted(got.get(i, []), key=lambda x: x[-1]) == want, text


def test_offsets_slice_back(spark):
    df = spark.createDataFrame([(1, "\U0001f600 Rom. 8. 1; é Rom. 9. 2 \U0001f600\U0001f600 rom. x. 3")], "id int, text string")
    rows = df.select("text", F.explode(citations.located(F.col("text"), citations.pattern())).alias("m")).collect()
    assert [r.text[r.m.start : r.m.start + len(r.m.parts[-1])] for r in rows] == [r.m.parts[-1] for r in rows] and len(rows) == 3


def test_verse_fields(spark):
    cases = [(None, None, None), ("", None, None), ("13", 13, None), ("13-17", 13, 17), ("13, 14, 15", 13, 15), ("7 – 7", 7, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "v string").select(citations.verse_range(F.col("v")).alias("x"))
    assert [(r.x.verse_start, r.x.verse_end) for r in df.collect()] == [c[1:] for c in cases]


@pytest.mark.parametrize(("parsed", "want"), [
    ("esv|Rom|8|13|8|17", [("romans", 8, 13, 17)]), ("|1John|3|16|0|0; |Psalm|27|0|0|0", [("1-john", 3, 16, None), ("psalms", 27, None, None)]), ("|Rom|8|13|8", []), ("|Rom|x|1|0|0", []),
    ("|Rom|0|0|0|0", []), ("|Nope|1|1|1|1", []), ("", []), (None, []), ("| 1-corinthians | 99 |2|1|2", [("1-corinthians", 99, 2, None)]),
])
def test_parsed_attributes(spark, parsed, want):
    df = spark.createDataFrame([(1, parsed)], "id int, parsed string")
    assert sorted((r.book_slug, r.chapter, r.verse_start, r.verse_end) for r in citations.decode_attribute(df).collect()) == sorted(want)


def test_canon():
    assert len(books()) == 82 and len(abbreviations()) == 335
    assert abbreviations()["rom"].name == "Romans" and abbreviations()["jam"].name == "James" and abbreviations()["sir"].slug == "sirach"
    assert attribute_names()["song of songs"].slug == "song-of-solomon" and attribute_names()["bel"].slug == "bel" and attribute_names()["wisdom"].order == 46
    assert [b.order for b in books()] == list(range(1, 83)) and sum(b.group == "Deuterocanon" for b in books()) == 16
