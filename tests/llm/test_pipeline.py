"""The pipeline against a brute-force version of it on a small corpus."""

import random
import re

import corpus_pipeline
import pytest

from versegrid.llm import language, neardup, secrets

from .test_decontaminate import _words
from .test_language import _text
from .test_mixing import _targets
from .test_neardup import brute as near_groups
from .test_secrets import _base


def _corpus():
    rng = random.Random(8)
    rows, passage = [], " ".join(f"bench{i}" for i in range(30))
    for i in range(150):
        lang = rng.choice(["aa", "bb", "cc"])
        text = _text(rng, lang, rng.randrange(20, 90))
        rows.append((i, text, lang if i % 9 else None, f"s{i % 4}" if i % 13 else None))
    for i in range(0, 40, 2):  # copies and near copies
        words = rows[i][1].split()
        rows.append((1000 + i, " ".join(words), rows[i][2], "s1"))
        rows.append((2000 + i, " ".join([*words[:-1], "tail"]), rows[i][2], "s2"))
    for i in range(6):
        rows.append((3000 + i, f"{_text(rng, 'bb', 60)} {passage.upper()}. {_text(rng, 'bb', 20)}", "bb", "s0"))
    rows.append((3100, passage, "bb", "s0"))
    rows += [(4000 + i, f"{_text(rng, 'aa', 30)} password={i:012d} {_text(rng, 'aa', 4)} AKIA{i:016d}", "aa", "s3") for i in range(5)]
    return rows + [(5000, None, "aa", "s1"), (5001, "12 34", "aa", "s1"), (5002, "中文字" * 40, None, "s1"), rows[0]], passage


def _clean(text, passage):
    w, p = _words(text), _words(passage)
    at = next((i for i in range(len(w)) if w[i : i + len(p)] == p), None)
    if at is None:
        return text
    if len(p) > 0.5 * len(w):
        return None
    return re.sub(re.escape(passage), "", text, flags=re.I)


def _redact(text):
    out, at = "", 0
    for a, _, b in _base(text):
        if a >= at:
            out += text[at:a] + secrets.REDACTED
        at = max(at, b)
    return out + text[at:]


def test_against_brute_force(spark, tmp_path):
    rows, passage = _corpus()
    full = [(d, t, l, s, None if t is None else len(t)) for d, t, l, s in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(full, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.createDataFrame(full, schema)
    judged = {r.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert {d for d, r in judged.items() if r.rejected} == {5000, 5001, 5002}
    kept = [r for r in rows if not judged[r[0]].rejected]
    least = {d: c for d, _, c in near_groups([(d, t) for d, t, _, _ in kept])}
    kept = {d: (t, s) for d, t, _, s in kept if least[d] == d}
    kept = {d: (_clean(t, passage), s) for d, (t, s) in kept.items()}
    kept = {d: (_redact(t), s) for d, (t, s) in kept.items() if t is not None}
    sizes = {}
    for t, s in kept.values():
        sizes[s] = sizes.get(s, 0) + len(t.encode().split())
    targets = _targets(sizes)
    assert all(r.text == kept[r.doc_id][0] and r.n_chars == len(r.text) and r.source == kept[r.doc_id][1] for r in got)
    assert len({r.doc_id for r in got}) == len(got) and all(r.lang for r in got)
    for s, size in sizes.items():
        mine = [r for r in got if r.source == s]
        largest = max(len(t.encode().split()) for t, x in kept.values() if x == s)
        assert abs(sum(r.taken for r in mine) - targets[s]) <= largest and all(r.source_size == size for r in mine)
        if targets[s] >= size:
            assert {r.doc_id for r in mine} == {d for d, (_, x) in kept.items() if x == s}


def test_stage_columns(spark, tmp_path):
    rows, passage = _corpus()
    docs = spark.createDataFrame([(d, t, l, s, 1) for d, t, l, s in rows[:20]], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).dtypes == docs.dtypes
    assert corpus_pipeline.STAGES[2][1](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_copies_from_080_go(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(20):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        near = [f"x{i}_{n}" if n in (30, 70, 110, 150) else w for n, w in enumerate(words)]
        rows += [(i, " ".join(words)), (100 + i, " ".join(near))]
    docs = spark.createDataFrame([(d, t, "aa", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == list(range(20))


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("most", [neardup.BROADCAST_IDS, 2])
def test_near_copies_go_by_row(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(neardup, "BROADCAST_IDS", most)
    rng = random.Random(11)
    say = lambda n=60: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    t, other, u, lone = say(), say(), say(), say()
    rows = [
        (2, t), (5, f"{t} more"), (5, other),  # the copy goes, the other version of its id stays
        (7, u), (7, f"{u} more"), (7, u),  # one of two versions that are near copies stays
        (None, f"{t} again"), (None, lone), (None, lone), (None, f"{lone} x"), (None, None), (8, None), (8, ""), (8, " "), (8, None),
        (9, lone.upper()),
    ]
    docs = spark.createDataFrame([(d, x, "aa", "s", 1) for d, x in rows], SCHEMA)
    got = sorted((str(r.doc_id), str(r.text)) for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect())
    one = [x for x in got if x[0] == "7"]
    assert len(one) == 1 and one[0][1] in (u, f"{u} more")
    assert [x for x in got if x[0] != "7"] == sorted([("2", t), ("5", other), ("9", lone.upper()), ("None", "None"), ("8", "None"), ("8", ""), ("8", " ")])


def test_stages_on_empty_tables_and_extra_columns(spark, tmp_path):
    spark.createDataFrame([(None, None), (1, " ")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, "ka ki ku mo", "aa", None, 1, "x", 0.5, 3), (None, None, None, None, None, None, None, None)], f"{SCHEMA}, label string, score double, size int")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        assert stage(spark, docs, str(tmp_path)).columns[:5] == list(corpus_pipeline.COLUMNS), name
