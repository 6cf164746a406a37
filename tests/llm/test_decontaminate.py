import hashlib
import random
import re

from versegrid.llm import decontaminate

from .fixtures import documents

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(t):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _brute(text, items):
    words, hit, found = _words(text), set(), set()
    for key, item in items:
        w = _words(item)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(key))
    return len(words), len(hit), sorted(found)


def _case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Éa", "X9"]
    say = lambda n: rng.choice([" ", "-", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 30]) if seed % 2 else rng.choice([10, 12, 40]))) for i in range(12)] + [(99, None)]
    docs = []
    for i in range(40):
        mid = rng.choice(items[:-1])[1]
        docs.append((i, f"{say(rng.randrange(0, 30))} {mid} {say(rng.randrange(0, 30))}"))
    return items, docs + [(100, None), (101, ""), (102, "---"), (0, docs[0][1])]


def test_matches_brute_force(spark):
    for seed in range(4):
        items, docs = _case(seed)
        bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id bigint, text string, hits string")
        for part_words in (100_000, 150):
            got = decontaminate.digest(decontaminate.find(documents(spark, docs), bench, part_words=part_words)).collect()
            want = sorted((d, *_brute(t, items)) for d, t in docs)
            told = sorted((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in got)
            assert told == [(d, n, h, hashlib.sha256(",".join(f).encode()).hexdigest()) for d, n, h, f in want]
            assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_cleaned_removes_the_passage(spark):
    passage = " ".join(f"word{i}" for i in range(15))
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    filler = " ".join(f"other{i}" for i in range(40))
    docs = documents(spark, [(1, f"\U0001f600é {filler} {passage.upper()}! tail"), (2, passage), (3, filler), (4, None)])
    out = {r.doc_id: r.text for r in decontaminate.cleaned(decontaminate.find(docs, bench, carry=("doc_id", "text"))).collect()}
    assert out == {1: f"\U0001f600é {filler} ! tail", 3: filler, 4: None}
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find(docs, empty).where("size(hits) > 0").count() == 0
    assert decontaminate.find(docs.limit(0), bench).count() == 0


def test_many_parts_equal_one(spark, monkeypatch):
    """Parts dealt on the executors, split and salted ones too, give what one automaton gives."""
    rng = random.Random(7)
    words = [f"v{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.choice([2, 5, 10, 25, 80])) + (" " + passage if i % 3 == 0 else "")) for i in range(300)]
    items += [(1000, "same " * 3000), (1000, "same " * 12), (None, passage), (1, items[1][1])]
    docs = []
    for i in range(400):
        own = items[rng.randrange(300)][1].split()
        at = rng.randrange(len(own))
        middle = passage if i % 3 == 0 else " ".join(own[at : at + rng.choice([4, 12, 60])])
        docs.append((i, f"É {say(20)} {middle.upper()}! {say(20)}"))
    docs += [(1000 + i, docs[0][1]) for i in range(200)] + [(2000, "same " * 5000), (2001, None), (2002, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = lambda found: sorted((r.doc_id, r.n_words, [tuple(h) for h in r.hits], r.items) for r in found.collect())
    want = rows(decontaminate.find(documents(spark, docs), bench))
    assert sum(bool(h) for _, _, h, _ in want) > 400
    monkeypatch.setattr(decontaminate, "TASK_WORDS", 3000)
    for part_words in (300, 5000):
        assert rows(decontaminate.find(documents(spark, docs), bench, part_words=part_words)) == want


def test_nothing_of_the_benchmark_is_held_by_the_driver(spark, monkeypatch):
    """Beyond one automaton's size no item reaches the driver."""
    def refuse(*_):
        raise AssertionError("items were gathered")

    monkeypatch.setattr(decontaminate, "one_part", refuse)
    bench = spark.range(200).selectExpr("id item_id", "concat_ws(' ', transform(sequence(1, 500), i -> concat('t', id, 'x', i))) text")
    docs = documents(spark, [(1, " ".join(f"t7x{i}" for i in range(40, 60))), (2, "t7x1 t8x2")])
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.digest(decontaminate.find(docs, bench, part_words=10_000)).collect()}
    assert got == {1: (20, 1), 2: (0, 0)}


def test_carried_texts_travel_once(spark, monkeypatch):
    """In the pipeline, each text went to Python and back twice, in one batch."""
    items, docs = _case(3)
    df, bench = documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find(df, bench, carry=("doc_id", "text"))
    assert "text_#" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.doc_id, r.text): (r.n_words, sum(h["to"] - h["from"] for h in r.hits), list(r["items"])) for r in found.collect()}
    assert got == {d: _brute(d[1], items) for d in docs}
