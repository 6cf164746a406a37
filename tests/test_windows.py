import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from versegrid.operators import citations, windows
from pyspark.sql import functions as F

from versegrid.operators.highlight import highlight_passage
from versegrid.plans import passages
from versegrid.plans.synth import Views


def test_sentences():
    assert windows.sentences("One thing here. Another thing there! Ok. Dr. Smith went home. See vol. Three.") == ["One thing here.", "Another thing there! Ok.", "Dr.Smith went home.", "See vol.Three."]
    assert windows.sentences("") == [] and windows.sentences("no end") == ["no end"]


def test_paragraph_and_window():
    body = " ".join(f"Sentence number {i} is here." for i in range(30))
    text = f"First para.\n \t\n{body}\n\nLast."
    t = windows.Text(text)
    a, b = t.window(text.index("number 15"))
    assert text[a:b].startswith("Sentence number 10") and text[a:b].endswith("number 19 is here.")
    a, b = t.window(text.index("number 0"))
    assert text[a:b].startswith("Sentence number 0 ") and text[a:b].endswith("number 9 is here.")
    a, b = t.window(text.index("number 29"))
    assert text[a:b].startswith("Sentence number 20") and text[a:b].endswith("number 29 is here.")
    assert text[slice(*t.window(0))] == "First para." and text[slice(*t.window(len(text) - 2))] == "Last."


def _paragraph(text, at):
    """Straight from the definition."""
    start = 0
    for m in re.finditer(r"\n[ \t]*\n", text):
        if m.end() <= at:
            start = m.end()
    m = re.compile(r"\n[ \t]*\n").search(text, at)
    return start, m.start() if m else len(text)


@given(st.text(alphabet="ab\n \t", max_size=40), st.integers(0, 40))
@settings(max_examples=400, deadline=None)
def test_paragraphs_by_definition(text, at):
    at = min(at, len(text))
    assert windows.Text(text).paragraph(at) == _paragraph(text, at)


def test_footnote_hop(spark):
    text = "Body with a claim [3] and so on.\n\nOther [3] later.\n\n   [3] Rom. 8. 1\n\n [4] Gen. i. 1"
    rows = spark.createDataFrame([(1, text)], "id int, text string")
    got = sorted((r.citation_offset, text[r.passage_start_offset : r.passage_end_offset]) for r in windows.spans(rows, citations.extract(rows)).collect())
    assert [p for _, p in got] == ["Other [3] later.", " [4] Gen. i. 1"]
    plain = windows.spans(rows, citations.extract(rows), footnotes=False).collect()
    assert sorted(text[r.passage_start_offset : r.passage_end_offset] for r in plain) == ["   [3] Rom. 8. 1", " [4] Gen. i. 1"]


def test_windows_hold_their_citation(spark):
    rng = random.Random(3)
    texts = [(i, "\n\n".join(" ".join(f"Word {rng.random():.3f} then Rom. {rng.randrange(1, 17)}. {rng.randrange(1, 30)}." for _ in range(rng.randrange(1, 25))) for _ in range(4))) for i in range(8)]
    rows = spark.createDataFrame(texts, "id int, text string")
    by = dict(texts)
    found = windows.spans(rows, citations.extract(rows)).collect()
    assert len(found) > 100
    for r in found:
        a, b = windows.Text(by[r.id]).paragraph(r.citation_offset)
        assert a <= r.passage_start_offset <= r.passage_end_offset <= b


def test_passages(spark):
    refs = spark.createDataFrame([(1, 0, 50), (1, 0, 50), (1, -5, 3), (2, 0, 5), (1, 9, 4)], "manuscript_id int, passage_start_offset int, passage_end_offset int")
    works = spark.createDataFrame([(1, "a.txt"), (2, "b.txt")], "id int, filename string")
    texts = spark.createDataFrame([("a.txt", "  ab\n\n\n\ncd ")], "filename string, text string")
    got = sorted((r.filename, r.passage_start_offset, r.passage) for r in windows.passages(refs, works, texts).collect())
    assert got == [("a.txt", -5, "a"), ("a.txt", 0, "ab\n\ncd"), ("a.txt", 9, ""), ("b.txt", 0, "[source file not found: b.txt]")]


def test_texts_of_passages_are_not_broadcast(spark):
    refs = spark.createDataFrame([(1, 0, 50)], "manuscript_id int, passage_start_offset int, passage_end_offset int")
    works = spark.createDataFrame([(1, "a.txt")], "id int, filename string")
    # Few bytes by the plan's guess, many as they are.
    texts = works.select("filename", F.repeat("filename", 1000).alias("text"))
    plan = windows.passages(refs, works, texts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [filename" in plan and "BroadcastHashJoin [filename" not in plan


def _marked(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, chapter int, key string")
    return [r.m for r in df.select("i", highlight_passage(F.col("text"), F.col("chapter"), F.col("key")).alias("m")).orderBy("i").collect()]


def test_highlight(spark):
    text = "Before it. He says (Rom. viii. 13) so. After <it>."
    plain = "Before it. He says (Rom. viii. 13) so. After &lt;it&gt;."
    got = _marked(
        spark, (text, 8, "13"), (text, 8, "whole"), (text, 8, None), (text, 9, "13"), (None, 1, "1"), ("Ps. cxix. 3", 119, "3-4"),
        ("\U0001f600 One. \"Two 3:4,\" he said. Three", 3, "4"), ("a\n\n b 3. 4 c\n\nd", 3, "4"), ("\nx 3:4 y?') Z", 3, "4,5"), ("x 3:4! y 3:4.  ", 3, "4"), ("x 13:4", 3, "4"), ("x 3:45", 3, "4"), ("I. 3:4", 3, "4"),
    )
    assert got == [
        "Before it. <mark>He says (Rom. viii. 13) so.</mark> After &lt;it&gt;.", plain, plain, plain, "", "<mark>Ps. cxix. 3</mark>",
        "\U0001f600 One. <mark>&quot;Two 3:4,&quot; he said.</mark> Three", "a\n\n <mark>b 3. 4 c\n\n</mark>d", "\n<mark>x 3:4 y?</mark>') Z", "<mark>x 3:4! y 3:4.</mark>  ", "<mark>x 13:4</mark>", "x 3:45", "<mark>I. 3:4</mark>",
    ]


def test_spans_and_one_pass_agree(spark):
    rng = random.Random(5)
    say = lambda: rng.choice(["Rom. 8. 1", "Dr. No", "vol. 3 went", "So [2] it is", "Gen. i. 1, 2", "Ok", "John 3:16"]) + rng.choice([". ", "! ", "? (", '." ', "\n", "\n\n", "\n[2] ", " "])
    rows = spark.createDataFrame([(i, "".join(say() for _ in range(rng.randrange(120)))) for i in range(30)] + [(99, None), (98, "")], "id int, text string")
    want = windows.spans(rows, citations.extract(rows))
    got = windows.cited(rows)
    order = sorted(got.columns)
    assert sorted(map(str, got.select(order).collect())) == sorted(map(str, want.select(order).collect())) and got.count() > 200


def test_many_citations_in_one_text(spark):
    text = "x " + "Rom. 8. 1; " * 3000
    got = sorted(r.citation_offset for r in citations.extract(spark.createDataFrame([(1, text)], "id int, text string")).collect())
    assert got == [2 + 11 * i for i in range(3000)]


def test_joined_texts_give_the_same_windows(spark):
    rng = random.Random(6)
    say = lambda: rng.choice(["Rom. 8. 1", "Dr. No", "vol. 3 went", "So [2] it is", "Gen. i. 1, 2", "Ok", "John 3:16"]) + rng.choice([". ", "! ", "? (", '." ', "\n", "\n\n", "\n[2] ", " "])
    by = {i: "".join(say() for _ in range(rng.randrange(120))) for i in range(30)}
    rows = spark.createDataFrame([*by.items(), (99, None), (98, "")], "id int, text string")
    found = citations.extract(rows)
    # References that are stored twice, of no known text, and without a place.
    refs = found.unionByName(found).unionByName(found.limit(1).withColumn("id", F.lit(77))).unionByName(found.limit(1).withColumn("citation_offset", F.lit(None).cast("int")))
    order = sorted(found.columns) + ["passage_start_offset", "passage_end_offset"]
    want = windows.spans(rows, refs).select(order)
    got = windows.joined(rows, refs, passage=True)
    assert sorted(map(str, got.select(order).collect())) == sorted(map(str, want.collect())) and want.count() > 400
    said = rows.join(got, "id").select("passage", windows.passage_text(F.col("text"), F.col("passage_start_offset"), F.col("passage_end_offset"), F.lit("")).alias("made"))
    assert said.where("not passage <=> made").count() == 0


def test_stored_texts_are_no_keys(spark):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no tables")
    plan = passages.stored_windows(Views(spark, data))._jdf.queryExecution().executedPlan().toString()
    # Every shuffle of texts or of what refers to them is by a short hash, and no text becomes a row a sentence.
    assert "hashpartitioning(text" not in plan and "bin_" not in plan


def _sentences(text):
    """Straight from the definition: pieces between stops, those behind abbreviations joined, short ones added."""
    pieces, at = [""], 0
    for m in windows._STOP.finditer(text):
        word = re.search(r"\w+\Z", text[at : m.start()].rstrip())
        pieces[-1] += text[at : m.end("mark")]
        at = m.end()
        if word is None or word[0].lower() not in windows.NO_END:
            pieces.append("")
    pieces[-1] += text[at:]
    out = []
    for said in filter(None, map(str.strip, pieces)):
        out[-1:] = [f"{out[-1]} {said}"] if out and len(said) < windows.SHORT else [*out[-1:], said]
    return out


@given(st.lists(st.sampled_from(["Dr", "no", "No", "i", "iii", "thess", "Xthess", "\u212a", " ", "  ", ". ", ".", "! ", " . ", "\n", "\x1c", "\u3000", "A", "(", '"', '") ', "abcdefgh", "_"]), max_size=25).map("".join))
@settings(max_examples=400, deadline=None)
def test_sentences_by_definition(text):
    assert windows.sentences(text) == _sentences(text)


def test_stored_references_are_found_once(spark):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no tables")
    for query in (passages.stored_windows, passages.stored_footnotes, passages.stored_passage_windows):
        plan = query(Views(spark, data))._jdf.queryExecution().executedPlan().toString()
        # The join reads references that are stored; it matches no text again.
        assert "(?iU)" not in plan


def test_texts_are_made_once(spark):
    made = spark.range(3).select("id", F.concat(F.lit("Rom. 8. "), F.col("id").cast("string")).alias("text"))
    names = spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, name string")
    plan = windows.cited(made.join(names, "id").select("id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    nullable = spark.createDataFrame([(1, "8. 1"), (2, None)], "id int, tail string").select("id", F.concat(F.lit("Rom. "), F.col("tail")).alias("text"))
    assert "isnotnull(concat" not in plan and "isnotnull(concat" not in windows.cited(nullable)._jdf.queryExecution().optimizedPlan().toString()
    assert [r.id for r in windows.cited(nullable).collect()] == [1]
    asked = spark.createDataFrame([(1, 0), (2, 0), (2, 5)], "id int, citation_offset int")
    assert [(r.id, r.passage_end_offset) for r in windows.joined(nullable, asked).collect()] == [(1, 9)]
