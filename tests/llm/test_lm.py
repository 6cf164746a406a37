import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np

from versegrid.llm import kernels as K
from versegrid.llm import lm

from .fixtures import documents


def _tokens(t):
    return re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).split() + [None]


def _docs(n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice("xyz")
        rows.append((i, " ".join(f"{lang}{min(rng.randrange(40), rng.randrange(40))}" if rng.random() < 0.9 else f"rare{rng.randrange(900)}" for _ in range(rng.randrange(5, 80)))))
    return rows + [(9001, None), (9002, ""), (9003, "X1 x1\x0bx1"), (9003, "X1 x1\x0bx1"), (None, "x1 never_seen_" + "q" * 300)]


def test_counts_and_base_scores(spark, monkeypatch):
    rows = _docs()
    for head in (10, lm.HEAD):
        monkeypatch.setattr(lm, "HEAD", head)
        got = lm.score(documents(spark, rows)).collect()
        train = Counter(t for d, x in rows if crc32(str("" if d is None else d).encode()) % 5 != 1 for t in _tokens(x))
        n, v = sum(train.values()), len(train)
        want = sorted((str(d), crc32(str("" if d is None else d).encode()) % 5 == 1, len(_tokens(x)), sum(train[t] > 0 for t in _tokens(x)), n, round(sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in _tokens(x)), 5)) for d, x in rows)
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    held = [r for r in got if r.held_out]
    # Held-out texts, whose words depend on the words before, are likelier under the model than under the unigrams.
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_probabilities_add_up(spark):
    docs = documents(spark, _docs(120))
    counts = lm.word_counts(docs.where(~lm.held_out(docs.doc_id)).select("text"))
    for words in (None, 40):
        model = lm.fit(docs, counts, words=words)
        n = len(model.parameters.leaf_bias)
        assert n == len(model.words) + len(model.buckets) and (words or model.distinct) >= len(model.words)
        for context in ([], [2], [2, 3], [n - 1, 5]):
            total = sum(math.exp(model.log_probability(np.array([*context, c]), np.zeros(len(context) + 1, int))[-1]) for c in range(n))
            assert abs(total - 1) < 1e-3


def test_words_without_a_leaf_have_a_bucket_as_target_and_context(spark):
    rows = _docs()
    docs = documents(spark, rows)
    counts = lm.word_counts(docs.where(~lm.held_out(docs.doc_id)).select("text"))
    model = lm.fit(docs, counts, words=40)
    every = np.array([r.h for r in counts.collect()])
    amount = {r.h: r.c for r in counts.collect()}
    leaves, norm = model.leaves(every)
    tail = ~model.own(every)
    assert tail.sum() > 100 and len(set(leaves[tail].tolist())) > 10
    # Shares within a bucket add up to one with the unseen words' half.
    for b in set(leaves[tail].tolist()):
        mine = tail & (leaves == b)
        assert abs(sum((amount[h] + 0.5) for h in every[mine].tolist()) + 0.5 - math.exp(norm[mine][0])) < 1e-6
    after = lambda c: model.log_probability(np.array([c, 3]), np.zeros(2, int))[-1]
    assert len({round(after(b), 9) for b in set(leaves[tail].tolist())}) > 5


def test_vocabulary_grows_and_reruns_agree(spark):
    assert [lm.vocabulary(n) for n in (10**4, 10**8, 10**11)] == [256, 3713, 37133]
    docs = documents(spark, _docs(150)).repartition(5, "doc_id")
    once, again = ({(r.doc_id, r.n_tokens): r.score for r in lm.score(docs).collect()} for _ in range(2))
    assert once == again


def test_groups_hold_all_leaves_in_order():
    amount = np.sort(np.random.default_rng(1).zipf(1.5, 900).astype(float))[::-1]
    t = lm.Tree.of(amount)
    assert t.first[0] == 0 and t.first[-1] == 900 and (np.diff(t.first) > 0).all() and t.groups <= 30
    assert all((t.group[a:b] == g).all() for g, (a, b) in enumerate(zip(t.first[:-1], t.first[1:], strict=True)))


def test_empty_and_untrained(spark):
    assert lm.score(documents(spark, [])).count() == 0
    only_held = [(d, "a b") for d in range(50) if crc32(str(d).encode()) % 5 == 1]
    got = lm.score(documents(spark, only_held)).collect()
    assert all((r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.score == r.base_score for r in got)


def test_scores_match_brute_force(spark):
    rows = _docs(120)
    docs = documents(spark, rows)
    counts = lm.word_counts(docs.where(~lm.held_out(docs.doc_id)).select("text"))
    model = lm.fit(docs, counts)
    p, t = model.parameters, model.tree
    train = Counter(x for d, text in rows if crc32(str("" if d is None else d).encode()) % 5 != 1 for x in _tokens(text))
    hashed = lambda word: lm.END_HASH if word is None else int(np.int64(np.uint64(K.one_word_hash(word)).astype(np.int64)))
    own = dict(zip(model.words.tolist(), model.numbers.tolist(), strict=True))

    def softmax(scores):
        e = np.exp(scores - scores.max())
        return e / e.sum()

    def probability(before, last, word):
        h = hashed(word)
        leaf = own.get(h, int(model.buckets[h % len(model.buckets)]))
        r = p.context[before] * p.places[0] + p.context[last] * p.places[1]
        g = t.group[leaf]
        a, b = t.first[g], t.first[g + 1]
        q = softmax(p.group @ r + p.group_bias)[g] * softmax(p.leaf[a:b] @ r + p.leaf_bias[a:b])[leaf - a]
        return leaf, q if h in own else q * (train[word] + 0.5) / math.exp(model.bucket_norm[h % len(model.buckets)])

    start = len(p.leaf_bias)
    got = {(r.doc_id, r.n_tokens): r.score for r in lm.score(docs).collect()}
    for d, text in rows[:40] + rows[-5:]:
        before, last, total = start, start, 0.0
        for word in _tokens(text):
            leaf, q = probability(before, last, word)
            total += math.log10(q)
            before, last = last, leaf
        assert abs(got[d, len(_tokens(text))] - total) < 1e-3 * max(1, len(_tokens(text)) / 20)
