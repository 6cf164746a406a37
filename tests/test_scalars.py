from pyspark.sql import functions as F

from versegrid.functions import scalars as S
from versegrid.functions.canon import int_to_roman, roman_to_int
from versegrid.operators.classify import category


def _values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()]


def test_roman(spark):
    cases = [("viii", 8), ("xiii", 13), ("cl", 150), ("IIII", 4), ("IC", 99), ("did", 999), ("", None), ("12", None), (None, None), (" iv ", 4)]
    assert _values(spark, [(a,) for a, _ in cases], "s string", roman_to_int(F.col("s"))) == [(b,) for _, b in cases]
    assert all(a == b for a, b in spark.range(1, 151).select("id", roman_to_int(int_to_roman(F.col("id")))).collect())


def test_creator(spark):
    cases = [("Berkhof, Louis (1873-1957)", "Louis Berkhof"), ("Matelda of Magdeburg", "Matelda of Magdeburg"), ("Anonymous", "Anonymous"), ("anon.", "Anonymous"), ("Augustine, Saint, Bishop of Hippo (345-430)", "Augustine"),
             ("Liguori, St. Alphonsus de (1696-1787)", "Alphonsus de Liguori"), ("Athanasius, Archbishop of Alexandria", "Athanasius"), ("Smith,", "Smith"), (None, None)]
    assert _values(spark, [(a,) for a, _ in cases], "s string", S.creator(F.col("s"))) == [(b,) for _, b in cases]


def test_header(spark):
    rule = "_" * 20
    text = f"x\n {rule}\n\n   Title: A Work\n  Creator(s): Last, First\n Print Basis: New York, 1899 (1901)\n CCEL subjects: All; Classic;; Early \n{rule}\nTitle: Other"
    head = S.header(F.col("t"))
    got = _values(spark, [(text,), ("Title: x",), (None,)], "t string", S.field(head, "Title"), S.header_author(head), S.header_year(head), S.subjects(head))
    assert got == [("A Work", "First Last", 1899, ["all", "classic", "early"]), (None, None, None, []), (None, None, None, [])]


def test_labels_keys_heat_buckets(spark):
    cases = [(None, None, None, "whole"), (13, None, "13", "13"), (13, 13, "13", "13"), (13, 17, "13-17", "13")]
    label = S.verse_label(F.col("a"), F.col("b"))
    assert _values(spark, [c[:2] for c in cases], "a int, b int", label, S.verse_key(label)) == [c[2:] for c in cases]
    counts = [(0, 0), (14, 1), (15, 2), (39, 2), (40, 3), (69, 3), (70, 4), (100, 4)]
    assert _values(spark, [(c,) for c, _ in counts], "c int", S.heat(F.col("c"), F.lit(100))) == [(h,) for _, h in counts]
    spans = [(199, 25), (200, 50), (500, 100), (1000, 200), (2000, 500)]
    assert _values(spark, [(s,) for s, _ in spans], "s int", S.bucket_width(F.col("s"))) == [(w,) for _, w in spans]
    assert _values(spark, [(1650,)], "y int", S.bucket(F.col("y"), F.lit(100)), S.percent(F.lit(1), F.lit(8))) == [(1600, 13)]


def test_text_helpers(spark):
    got = _values(spark, [("a<b>&\"c\"\nd",), (None,)], "t string", S.escaped(F.col("t")), S.preview(F.col("t")), S.passage_key(F.lit("x/y.txt"), F.lit(1), F.lit(2)), S.or_else(F.nullif(F.lit(""), F.lit("")), "z"))
    assert got == [("a&lt;b&gt;&amp;&quot;c&quot;\nd", 'a<b>&"c" d', "y_1_2", "z"), ("", None, "y_1_2", "z")]
    labels = _values(spark, [("Romans", 8, 13, 17), ("Romans", 8, None, None), ("Romans", 8, 0, 4)], "b string, c int, s int, e int", S.reference_label(F.col("b"), F.col("c"), F.col("s"), F.col("e")))
    assert [x[0].rstrip() for x in labels] == ["Romans 8:13-17", "Romans 8", "Romans 8"] and all(len(x[0]) == 30 for x in labels)
    assert _values(spark, [("a_b_c",), ("abc",)], "s string", S.work_url(F.col("s"), "u")) == [("u/a_b/c",), (None,)]
    assert _values(spark, [("x" * 21,)], "s string", S.shortened(F.col("s"), 20)) == [("x" * 19 + "…",)]
    assert _values(spark, [(1500.0,)], "s double", S.tick_step(F.col("s")), S.marker_radius(F.lit(5), F.lit(10))) == [(200.0, 8.0)]


def test_category_order(spark):
    cases = [
        (("x/anf01.txt", None, "History", None, []), "Patristics"), (("a.txt", "Calvin", "Commentary on X", None, []), "Biblical Commentary"), (("a.txt", None, "x", None, ["bible"]), "Scripture"),
        (("a.txt", "Owen", "x", 599, []), "Patristics"), (("a.txt", "Owen", "x", 600, []), "Medieval"), (("a.txt", "Owen", "x", 0, []), "Puritan"), (("a.txt", "D. H. Lawrence", "x", 1900, []), "Medieval"),
        (("a.txt", None, "St. Dionysius of Alexandria", None, None), "Patristics"), (("a.txt", "Leonard", "x", 1900, []), "Patristics"), (("a.txt", None, "An Exposition of Y", None, []), "Biblical Commentary"),
        (("a.txt", None, "Life of Z", None, []), "Church History"), (("hymns.txt", None, None, None, []), "Devotional"), (("a.txt", None, "On Eckhart", None, []), "Medieval"), (("a.txt", None, None, None, None), "Other"),
    ]
    got = _values(spark, [c[0] for c in cases], "f string, a string, t string, y int, s array<string>", category(F.col("f"), F.col("a"), F.col("t"), F.col("y"), F.col("s")))
    assert [g[0] for g in got] == [c[1] for c in cases]
