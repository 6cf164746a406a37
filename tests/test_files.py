"""Text files as a data source: planning, decoding, writing."""

import os

import pytest
from pyspark.sql import functions as F

from versegrid.functions import registry
from versegrid.sources import files, texts, thml


def test_partitions_are_planned_by_bytes():
    sizes = [("big", 900), *((f"s{i}", 10) for i in range(7)), ("middle", 400)]
    parts = files.planned([(n, s * 1000) for n, s in sizes], 1_000_000)
    assert sorted(p for part in parts for p, _ in part) == sorted(n for n, _ in sizes)
    assert parts[0] == [("big", 900_000)] and all(len(p) == 1 or sum(s + files.OPENED for _, s in p) <= 1_000_000 for p in parts)
    assert files.planned([], 10) == [] and len(files.planned([("a", 99), ("b", 99)], 1)) == 2


def test_read(spark, tmp_path):
    files.register(spark)
    bodies = {"a.txt": "é\r\nx\ry\n".encode(), "b.txt": b"", "c.md": b"no", "d.txt": b"\xff\xfe(\xc3\xe2\x82A", ".e.txt": b"hidden", "_f.txt": b"hidden"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "g.txt").write_text("deep")
    load = lambda **o: {r.filename: r.text for r in spark.read.format("texts").options(path=str(tmp_path), **o).load().collect()}
    assert load(leastBytes=0) == {"a.txt": "é\nx\ny\n", "b.txt": "", "d.txt": bodies["d.txt"].decode("utf-8", "replace")}
    assert set(load(leastBytes=1, recursive=True)) == {"a.txt", "d.txt", "g.txt"} and load() == {} and load(leastBytes=0, pattern="z*") == {}
    rows = spark.read.format("texts").options(path=str(tmp_path), leastBytes=0, partitionBytes=1).load()
    assert rows.rdd.getNumPartitions() == 3 and rows.where("length > 5").select("path").count() == 2


def test_both_readers_agree(spark, tmp_path):
    files.register(spark)
    for i in range(40):
        (tmp_path / f"{i}.txt").write_bytes(os.urandom(30) + b"\r\n\r" * 5 + b"x" * (i * 100) + "é𐐀".encode()[: i % 7])
    got = spark.read.format("texts").option("path", str(tmp_path)).load().select("filename", "text")
    want = texts.read_texts(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 30


def test_write_and_read_again(spark, tmp_path):
    files.register(spark)
    rows = spark.createDataFrame([("a.txt", "one\n"), ("x/b.txt", "é"), ("c.txt", None), ("p.txt.zst", "packed " * 99)], "filename string, text string")
    to = str(tmp_path / "out")
    rows.write.format("texts").mode("append").save(to)
    again = lambda **o: {r.filename: r.text for r in spark.read.format("texts").options(path=to, leastBytes=0, recursive=True, **o).load().collect()}
    assert again() == {"a.txt": "one\n", "b.txt": "é", "c.txt": ""} and again(pattern="*.zst") == {"p.txt": "packed " * 99}
    assert os.path.getsize(tmp_path / "out" / "p.txt.zst") < 100 and (tmp_path / "out" / "_SUCCESS").exists()
    rows.where("filename = 'a.txt'").withColumn("text", F.lit("two")).write.format("texts").mode("append").save(to)
    assert again()["a.txt"] == "two" and len(again()) == 3
    rows.where("filename = 'a.txt'").write.format("texts").mode("overwrite").save(to)
    assert again() == {"a.txt": "one\n"} and not [f for f in os.listdir(to) if "draft" in f]
    with pytest.raises(Exception, match="filename"):
        spark.range(1).write.format("texts").mode("append").save(to)


def test_hits_as_a_table(spark):
    registry.register(spark)
    xml = '<a>x <scripRef parsed="|Romans|8|1|0|0">y</scripRef> <scripRef>z</scripRef><note><scripRef parsed="q"/></note></a>'
    spark.createDataFrame([(1, xml), (2, None), (3, ""), (4, "<a/>"), (5, xml * 2)], "id int, content string").createOrReplaceTempView("hit_texts")
    got = sorted(map(tuple, spark.sql("SELECT id, h.* FROM hit_texts, LATERAL thml_hits(content) h").collect()), key=str)
    want = sorted(((i, *h) for i, x in ((1, xml), (5, xml * 2)) for h in thml.walk(x)["hits"]), key=str)
    assert got == want and len(got) == 6


def test_hits_come_by_batches(spark):
    """A call in Python for each document, with its rows handed over one by one, was most of the time."""
    registry.register(spark)
    spark.range(3).selectExpr("id", "'<a><scripRef parsed=\"q\"/></a>' AS content").createOrReplaceTempView("hit_batches")
    found = spark.sql("SELECT id, h.* FROM hit_batches, LATERAL thml_hits(content) h")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "UDTF" not in plan and "Join" not in plan
    assert sorted(map(tuple, found.collect())) == [(i, "q", 0) for i in range(3)]


def test_partitions_of_large_folders_grow(spark, tmp_path):
    """A task for 16 small files each was most of the time of a folder of many."""
    many = [(f"d/{i}", 2000) for i in range(50_000)]
    parts = files.planned(many, files.roomy(many, 1 << 20))
    assert sorted(f for part in parts for f in part) == sorted(many) and len(parts) <= files.PARTS + 2
    assert files.roomy(many[:100], 1 << 20) == 1 << 20 and files.roomy([], 5) == 5 and files.roomy(many, files.GROWN * 2) == files.GROWN * 2
    assert files.roomy([("a", files.GROWN * files.PARTS * 4)], 1) == files.GROWN
    files.register(spark)
    for i in range(600):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    rows = spark.read.format("texts").options(path=str(tmp_path), leastBytes=0, partitionBytes=1).load()
    assert rows.rdd.getNumPartitions() <= files.PARTS + 50 and sorted(r.text for r in rows.collect()) == sorted(f"text {i}" for i in range(600))
