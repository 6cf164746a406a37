"""Cases that every operator on documents meets: clashing columns, very long texts, nulls, repeated rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from versegrid.llm import decontaminate, language, lm, mixing, neardup, secrets, suffix

#: Names that the operators use for columns of their own.
CLASHING = (
    "doc", "th", "shard", "kind", "blob", "covered", "asked", "hot", "carry_doc_id", "carry_text", "text_", "body", "owner", "repo", "base", "more", "found", "list", "live", "hash", "size", "h", "salt", "copies",
    "target", "budget", "hits", "items", "n_words", "part", "rare", "times", "logs", "r", "c", "same", "v", "sig", "label", "component", "k2", "node", "id_", "same_", "held_out", "lang_pred", "score", "rejected", "row", "known",
)
LONG = 300_000


def _documents(spark):
    rng = random.Random(2)
    long = " ".join(f"w{rng.randrange(40_000)}" for _ in range(LONG // 5)) + " password=longenough1 "
    said = " ".join(f"s{i}" for i in range(40))
    rows = [(1, f"{long}{said}", "aa", "x"), (2, f"{said} {long}", "aa", None), (3, None, "bb", "x"), (4, "", None, "y"), (5, said, "bb", "y"), (5, said, "bb", "y"), (5, f"{said} other", "bb", "y"), (None, said, "aa", None), (None, None, None, None), (6, "12 34", "aa", "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), spark.createDataFrame([(1, said), (None, None), (2, ""), (3, "s1 s2")], "item_id bigint, text string")


OPERATORS = {
    "op2": lambda d, _: secrets.digest(secrets.scan(d)),
    "op3": lambda d, _: suffix.digest(suffix.repeats(d)),
    "op4": lambda d, _: mixing.mix(d),
    "op6": lambda d, b: decontaminate.digest(decontaminate.find(d, b)),
    "op7": lambda d, _: lm.score(d).withColumn("score", F.round("score", 3)).withColumn("base_score", F.round("base_score", 3)),
    "op8": lambda d, _: language.identify(d, language.fit(d)).withColumn("score", F.round("score", 5)),
    "op10": lambda d, _: neardup.link(d),
    "one_of_each": lambda d, _: neardup.one_of_each(d).select("doc_id", "text", "lang", "source"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_and_long_texts(spark, name):
    docs, items = _documents(spark)
    more = docs.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASHING])
    items_more = items.select("*", *[F.lit(1).alias(c) for c in CLASHING])
    plain = sorted(map(str, OPERATORS[name](docs, items).collect()))
    assert sorted(map(str, OPERATORS[name](more, items_more).collect())) == plain
    assert len(plain) == (docs.count() if name != "one_of_each" else len(plain))
    assert OPERATORS[name](more.limit(0), items_more.limit(0)).count() == 0


def test_long_texts_are_read_to_their_ends(spark):
    docs, items = _documents(spark)
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    longest = next(t for d, t in rows if d == 1)
    got = {r.doc_id: r for r in suffix.digest(suffix.repeats(docs)).collect()}
    # All of the second text but its own joints stands in the first.
    assert got[1].n_removed == 0 and got[1].n_bytes == len(longest) and got[2].n_removed >= got[2].n_bytes - 2
    assert got[1].kept_sha256 == hashlib.sha256(longest.encode()).hexdigest()
    hit = {r.doc_id: r for r in decontaminate.digest(decontaminate.find(docs.where("doc_id < 3"), items)).collect()}
    assert hit[1].n_hit == hit[2].n_hit == 40 and hit[1].n_words > LONG // 5
    size = {r.doc_id: r["size"] for r in mixing.mix(docs.where("doc_id < 3")).collect()}
    assert size[1] == size[2] == len(longest.split())
    scored = {r.doc_id: r for r in lm.score(docs.where("doc_id < 3")).collect()}
    assert scored[1].n_tokens == len(longest.split()) + 1
    assert {r.spans.split(":")[0] for r in secrets.digest(secrets.scan(docs.where("doc_id < 3"))).collect()} == {"assign"}
