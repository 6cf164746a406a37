"""The text index against a scan."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from versegrid.functions.scalars import mentions
from versegrid.operators import search
from versegrid.operators.search import TextIndex


def _both(spark, folder, rows, terms):
    texts = spark.createDataFrame(rows, "id int, a string, b string")
    index = TextIndex(spark, str(folder)).build(texts, "id", F.col("a"), F.col("b"))
    got = sorted((r.term, r.key) for r in index.search(spark.createDataFrame([(t,) for t in terms], "term string")).collect())
    want = sorted({(t, r.id) for t in set(terms) - {None} for r in texts.where(mentions(t, F.col("a"), F.col("b"))).collect() if r.id is not None})
    assert got == want
    return got


ROWS = [(1, "John Owen", "Of Sin"), (2, None, "É été 𐐀x"), (3, "", ""), (4, "a", None), (5, "aaaa", "aa"), (5, "other", "version"), (None, "John", "x"), (6, "100%", "a.b*c\nd"), (7, "John  Owen", "OF")]


def test_equals_the_scan(spark, tmp_path):
    terms = ["john", "JOHN", "n o", "owen of", "", " ", "aa", "aaa", "aaaaa", "a", "É", "éTé", "𐐀", "𐐀x", "%", "0%", "a.b", "c\nd", "zzz", "z", "zz", "n  o", None, "john", "owen of sin", "n of si"]
    assert len(_both(spark, tmp_path, ROWS, terms)) > 20


def test_many_rows_and_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 16)
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
    rows = [(i, " ".join(word() for _ in range(4)), word()) for i in range(150)]
    _both(spark, tmp_path, rows, [word() for _ in range(20)] + [f"{word()} {word()}" for _ in range(10)])
    assert spark.read.parquet(str(tmp_path / "postings")).groupBy("gram").count().agg(F.max("count")).first()[0] > 4


def test_empty_tables(spark, tmp_path):
    assert _both(spark, tmp_path / "a", [], ["", "a", "abc"]) == []
    assert _both(spark, tmp_path / "b", ROWS, []) == []


def test_lists_are_made_where_the_texts_stand(spark, tmp_path, monkeypatch):
    """A row for each gram of each text, shuffled and gathered, was most of the time: lists come by blocks, long texts in parts."""
    monkeypatch.setattr(search, "BYTES", 50)
    rows = [(i, ("long é " * 40 + f"n{i}") if i % 3 else f"short{i}", None) for i in range(60)]
    assert len(_both(spark, tmp_path / "a", rows, ["g é l", "é", "n1", "t5", "ong", "LONG É LONG", "g n", "\u0000", "9\u0000", "short57 "])) > 60
    monkeypatch.setattr(search, "BYTES", 1 << 20)
    TextIndex(spark, str(tmp_path / "b")).build(spark.createDataFrame(rows, "id int, a string, b string").coalesce(1), "id", F.col("a"))
    lists = spark.read.parquet(str(tmp_path / "b" / "postings"))
    assert lists.groupBy("gram").count().agg(F.max("count")).first()[0] == 1 and lists.agg(F.max("n")).first()[0] == 40
    made = search._postings(4096, 1 << 20)

    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([b"aaaa\xff\xff", b"\xff\xff"], pa.binary())], names=["key", "raw"])
    assert [b.column(2).to_pylist() for b in made([batch])] == [[[7], [7], [7]]]


def test_many_grams_meet_the_lists_in_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_GRAMS", 0)
    assert len(_both(spark, tmp_path, ROWS, ["john", "aa", "É", "owen of sin", ""])) > 5
