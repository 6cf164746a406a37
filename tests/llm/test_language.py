import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from versegrid.llm import language

from .fixtures import documents

SOUNDS = {"aa": "ka ki ku mo na ri to", "bb": "schl ber gen heit ung ver stra", "cc": "éou eau ais tion que ère ment"}


def _text(rng, lang, n):
    return " ".join("".join(rng.choices(SOUNDS[lang].split(), k=rng.randrange(1, 4))) for _ in range(n))


def _docs(spark, n=240):
    rng = random.Random(5)
    rows = [(i, _text(rng, lang := rng.choice(list(SOUNDS)), rng.randrange(5, 60)), lang) for i in range(n)]
    odd = [(9001, None, "aa"), (9002, "", "bb"), (9003, "12 34 !?", "cc"), (9004, _text(rng, "bb", 20_000), None), (9005, "中文字" * 30, None), (None, _text(rng, "cc", 30), "cc")]
    return documents(spark, rows + odd + odd[:1]), {i: lang for i, _, lang in rows}


def test_held_out_accuracy_and_odd_rows(spark):
    docs, truth = _docs(spark)
    model = language.fit(docs)
    assert len(set(model.languages)) == 3 and len(model.languages) > 3
    got = language.identify(docs, model).withColumn("held_out", language.held_out(F.col("doc_id"))).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert not any(r.rejected for r in held) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True) for i in (9001, 9002, 9003))
    assert by[9004].lang_pred == "bb" and by[9005].lang_pred in SOUNDS and by[9005].rejected


def test_every_size_of_a_language_has_a_sample(spark):
    h = spark.range(100_000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / float(1 << 53)).alias("h"))
    least = lambda n: h.where(language.sampled(F.col("h") / 1e9, F.lit(float(n)), 400)).count()
    # Hashes a billion times smaller stand for the least ones of a language of 1e14 rows.
    assert least(1e14) > 200 and h.where(language.sampled(F.col("h"), F.lit(300.0), 400)).count() == 100_000


def test_many_languages_are_joined_by_salt(spark, monkeypatch):
    docs, _ = _docs(spark)
    want = sorted(tuple(r) for r in language.training_sample(docs, "doc_id", "text", "lang", 20).collect())
    monkeypatch.setattr(language, "FEW_LANGUAGES", 1)
    assert sorted(tuple(r) for r in language.training_sample(docs, "doc_id", "text", "lang", 20).collect()) == want and want


def test_without_labels_or_rows(spark):
    docs = documents(spark, [(1, "abc", None)])
    model = language.fit(docs)
    assert [tuple(r) for r in language.identify(docs, model).collect()] == [(1, "und", 0.0, True)]
    assert language.identify(documents(spark, []), model).count() == 0


def test_no_language_is_left_out(spark):
    rng = random.Random(6)
    sounds = {f"l{i:03}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(5)] for i in range(230)}
    docs = documents(spark, [(i, " ".join(rng.choices(sounds[lang], k=30)), lang) for i, lang in enumerate(sorted(sounds) * 6)])
    model = language.fit(docs)
    assert set(model.languages) == set(sounds)
    got = language.identify(docs, model, carry=("doc_id", "lang")).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_predictions_match_brute_force(spark):
    docs, _ = _docs(spark, 120)
    model = language.fit(docs)

    def grams(text):
        low = "".join(c.lower() if c.isascii() else c for c in text).encode()
        spaced = re.sub(rb"[^a-z\x80-\xff]+", b" ", low)
        return Counter(spaced[i : i + k] for k in language.GRAMS for i in range(len(spaced) - k + 1))

    def bucket(gram):
        h = gram[0]
        for b in gram[1:]:
            h = (h * 0x01000193 & 0xFFFFFFFF) ^ b
        return ((h * 0x9E3779B1 + len(gram)) * 0x85EBCA6B & 0xFFFFFFFF) >> 19

    for r in language.identify(docs, model, carry=("doc_id", "text")).collect():
        weights = {}
        for gram, n in grams(r.text or "").items():
            weights[bucket(gram)] = weights.get(bucket(gram), 0) + n
        weights = {b: math.log1p(n) * float(model.idf[b]) for b, n in weights.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        cosines = [sum(w * float(c[b]) for b, w in weights.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert abs(r.score - max(0.0, cosines[best])) < 1e-4
        if sorted(cosines)[-2] < cosines[best] - 1e-4:
            assert r.lang_pred == model.languages[best] and (abs(cosines[best] - model.floor[best]) < 1e-4 or r.rejected == (cosines[best] < model.floor[best]))


def test_rows_that_share_an_id_or_a_text_teach_their_language(spark):
    """Whatever id or text most rows of a language share, the language is learned, and copies don't fill the sample."""
    shared = [(i, f"der und die {n} das ist nicht wahr", "de", "x") for i in (3, 5, 11, 12) for n in range(200)]
    copies = [(i * 4, "the one text that all have", "en", "x") for i in range(2000)]
    rows = documents(spark, [*shared, *copies])
    told = {r.lang: r["count"] for r in language.training_sample(rows, "doc_id", "text", "lang", 50).groupBy("lang").count().collect()}
    assert told["en"] == 1 and 20 < told["de"] < 110
    assert set(language.fit(rows).languages) == {"de", "en"}
    one = documents(spark, [(i, f"wort {n}", f"l{i}", "x") for i in (3, 5, 11, 12) for n in range(100)])
    assert len(set(language.fit(one).languages)) == len({r.lang for r in one.where(~language.held_out(F.col("doc_id"))).collect()})
