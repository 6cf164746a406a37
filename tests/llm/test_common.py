"""Runs that are cut out of texts."""

import random
import time

from pyspark.sql import functions as F

from versegrid.llm import decontaminate, secrets
from versegrid.llm.common import merged, running_max, without


def _plain(text, spans, mark):
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_by_definition(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        text = "".join(rng.choice("ab é𐐀\n") for _ in range(rng.randrange(0, 900)))
        spans = [(a, min(len(text), a + rng.randrange(1, 9))) for a in (rng.randrange(len(text)) for _ in range(rng.randrange(400) if text else 0))]
        rows.append((i, text, sorted(spans)))
    df = spark.createDataFrame(rows, "i int, t string, s array<struct<start:int,end:int>>")
    a, b = F.transform("s", lambda x: x["start"]), F.transform("s", lambda x: x["end"])
    got = {r.i: r for r in df.select("i", without(F.col("t"), merged(a, b), "<>").alias("t"), running_max(b).alias("m")).collect()}
    for i, text, spans in rows:
        assert got[i].t == _plain(text, spans, "<>")
        most = 0
        assert got[i].m == [most := max(most, e) for _, e in spans]


def test_many_spans_take_seconds(spark):
    n = 100_000
    df = spark.range(1).select(F.repeat(F.lit("ab password=longenough1\n"), n).alias("text"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct((i * 24 + 3).alias("start"), F.lit(0).alias("kind"), (i * 24 + 23).alias("end"), F.lit("h").alias("hash"))).alias("spans"))
    began = time.time()
    got = df.select(secrets.redact(F.col("text"), F.col("spans")).alias("t")).first().t
    assert got == f"ab {secrets.REDACTED}\n" * n and time.time() - began < 30
    hits = F.transform("spans", lambda s: F.struct((s["kind"]).alias("from"), (s["kind"] + 1).alias("to"), s["start"].alias("char_from"), s["end"].alias("char_to")))
    began = time.time()
    found = df.select("text", hits.alias("hits"), F.lit(10**9).alias("n_words"))
    assert decontaminate.cleaned(found).first().text == "ab \n" * n and time.time() - began < 30
