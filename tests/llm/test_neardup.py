import random
import re

import numpy as np

from versegrid.llm import neardup

from .fixtures import documents


def _set(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(d, _set(t)) for d, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def _corpus(seed, families=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 12, 60, 200, 400]))
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, len(words) // 60, len(words) // 40, len(words) // 25])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, rng.choice([" ", "\n ", "\x0b"]).join(words)))
    rng.shuffle(rows)
    return rows


def test_components_match_brute_force(spark):
    rows = _corpus(1) + [(90001, None), (90002, ""), (90003, " \n"), (90004, "one two"), (90005, "ONE two")]
    got = sorted(tuple(r)[:3] for r in neardup.link(documents(spark, rows)).collect())
    assert got == brute(rows)


def test_large_nodes_blocks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 3)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 5)
    rows = _corpus(2, families=4, copies=20) + [(80000 + i, " ".join(f"x{j}" for j in range(30_000)) + f" end{i}") for i in range(3)]
    got = sorted(tuple(r)[:3] for r in neardup.link(documents(spark, rows)).collect())
    assert got == brute(rows)


def test_repeats_nulls_and_empty(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(5, text), (5, text), (5, "other text of one two three"), (None, text), (2, text + " more"), (None, None)]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in neardup.link(documents(spark, rows)).collect())
    assert got == [("2", 37, "2", True), ("5", 2, "5", True), ("5", 36, "2", False), ("5", 36, "2", False), ("None", 0, "None", True), ("None", 36, "None", True)]
    assert neardup.link(documents(spark, [])).count() == 0


def test_links_of_a_node_grow_with_its_documents():
    """Near copies give a link a document from each node, not one a pair, and stay connected as all pairs connect them."""
    rng = np.random.default_rng(3)
    alike = np.zeros((neardup.SMALL, neardup.TOKENS), np.uint32)
    # Chains, stars and strangers: documents of a node that agree with some of its others only.
    mixed = rng.integers(0, 2, (300, neardup.TOKENS), np.uint32)
    sig, node = np.concatenate((alike, mixed)), np.concatenate((np.full(neardup.SMALL, 1), 2 + np.sort(rng.integers(0, 20, 300))))
    doc = rng.permutation(len(node)) * 7
    order = np.lexsort((doc, node))
    node, doc, sig = node[order], doc[order], sig[order]
    links = [(a, b) for batch in neardup._pairs(node, doc, sig, 0.6) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
    at = {d: i for i, d in enumerate(doc.tolist())}
    got, want = neardup.Forest(len(doc)), neardup.Forest(len(doc))
    assert all(a < b and node[at[a]] == node[at[b]] for a, b in links)
    assert all(got.join(at[a], at[b]) for a, b in links) and sum(node[at[a]] == 1 for a, _ in links) == neardup.SMALL - 1
    joined = [want.join(i, j) for i in range(len(doc)) for j in range(i) if node[i] == node[j] and (sig[i] == sig[j]).mean() >= 0.6]
    assert [got.find(i) for i in range(len(doc))] == [want.find(i) for i in range(len(doc))] and neardup.SMALL <= len(links) < len(joined)


def test_confirmed_links_of_a_large_group_are_told_once(spark, monkeypatch):
    """Blocks that the least document links gave their own links again to each block of the rest."""
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 4)
    told, real = [], neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda *a: told.append(neardup.cut(real(*a))) or told[0])
    base = [f"w{i}" for i in range(100)]
    # A row of drifting copies: the least document links the first ones, these the next, and so on.
    rows = [(n, " ".join([f"z{i}" for i in range(n)] + base[n:])) for n in range(40)]
    got = sorted(tuple(r)[:3] for r in neardup.link(documents(spark, rows)).collect())
    assert got == brute(rows) and {c for _, _, c in got} == {0} and told[0].count() <= 3 * len(rows)
