"""Native sentences, windows and interval joins against their plain versions."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from versegrid.operators import sentences, windows
from versegrid.operators.intervals import within

_PARTS = ["Rom. 8. 1", "Dr. No", "St. John said", "vol. 3 went", "VOL.\nThree", "So it is", "Ok", "Yes", "a", 'He said "so." ', "(etc.) Then", "mr . X", "É. Å", "x\x1cy. \x1cZ", "etc.. A", "So it is", "Dr.No", " ", "One two three"]
_ENDS = [". ", "! ", "? (", '." ', ".  ", "\n", " ", ". \n", ".", " . "]


def _text(rng, n):
    return "".join(rng.choice(_PARTS) + rng.choice(_ENDS) for _ in range(n))


def test_sentences_equal_the_plain_ones(spark):
    rng = random.Random(1)
    texts = ["", " ", "no end", "A. b", ". A", "Hi. " * 30, "Long enough here. " * 400, *(_text(rng, rng.randrange(60)) for _ in range(400))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string")
    got = {r.i: r.s for r in rows.select("i", sentences.sentences(F.col("t")).alias("s")).collect()}
    assert got[-1] is None
    for i, t in enumerate(texts):
        assert got[i] == windows.sentences(t), t


def test_windows_equal_the_plain_ones(spark):
    rng = random.Random(2)
    texts = ["Hi there you. " * 30, "So it is. Dr. No went. " * 300, *(_text(rng, rng.randrange(10, 90)) for _ in range(250))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in rows.select("i", sentences.windows(F.col("t")).alias("w")).collect()}
    for i, t in enumerate(texts):
        plain, held = windows.Paragraph.of(t, 0, len(t)), sorted(got[i])
        # The intervals are apart and leave nothing out.
        assert held[0].low == 0 and all(a.high + 1 == b.low for a, b in zip(held, held[1:], strict=False)) and held[-1].high >= len(t)
        for at in range(len(t) if i > 1 else 500):
            w = next(w for w in held if w.low <= at <= w.high)
            assert (w.start, w.end) == plain.window(at, t), (t, at)


def test_no_python_and_no_shuffle_of_texts(spark):
    texts = spark.range(9).select("id", F.lit("Rom. 8. 1. So it is [1].\n\n[1] Gen. 1. 1").alias("text"))
    refs = texts.select("id", F.lit(0).alias("citation_offset"))
    plan = windows.spans(texts, refs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert not any("Exchange" in line and "text#" in line for line in plan.split("\n"))


def test_many_citations_of_one_text(spark):
    n = 200_000
    texts = spark.createDataFrame([(1, "Aa bb cc dd. " * 7 + "\n\n"), (2, "x" * 50)], "id int, text string").withColumn("text", F.when(F.col("id") == 1, F.repeat("text", 2000)).otherwise(F.col("text")))
    refs = spark.range(n).select(F.lit(1).alias("id"), (F.col("id") % (13 * 7 * 2000)).cast("int").alias("citation_offset"), F.col("id").alias("n"))
    got = windows.spans(texts, refs)
    assert got.count() == n
    size = 13 * 7 + 2
    wrong = got.where((F.col("passage_start_offset") != F.floor(F.col("citation_offset") / size) * size) | (F.col("passage_end_offset") - F.col("passage_start_offset") != size - 2))
    assert wrong.count() == 0


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.integers(0, 30)), max_size=12), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99)), max_size=12))
@settings(max_examples=8, deadline=None)
def test_within_by_definition(spark, spans, places):
    intervals = spark.createDataFrame([(k, a, a + n, i) for i, (k, a, n) in enumerate(spans)], "k int, low_ int, high_ int, i int")
    points = spark.createDataFrame(places, "k int, at int")
    want = sorted((k, at, i) for k, at in places for i, (j, a, n) in enumerate(spans) if j == k and a <= at <= a + n)
    assert sorted(map(tuple, within(points, intervals, "k", "at", width=7).collect())) == want
