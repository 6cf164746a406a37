import numpy as np

from versegrid.llm import vectors


def _brute(rows, threshold=0.95):
    ok = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    links, up = {i: 0 for i in range(len(ok))}, list(range(len(ok)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ok)):
        for j in range(i):
            a, b = np.array(ok[i][1], np.float32).astype(float), np.array(ok[j][1], np.float32).astype(float)
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    least = {}
    for i, (v, _) in enumerate(ok):
        least[find(i)] = min(least.get(find(i), v), v)
    alone = [(v, 0, v) for v, x in rows if not any(v == k for k, _ in ok)]
    return sorted([(v, links[i], least[find(i)]) for i, (v, _) in enumerate(ok)] + alone)


def _rows(seed, n=300, d=64):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 6, d))
    rows = [(i * 2, (base[rng.integers(len(base))] + rng.choice([0, 0.15, 0.22, 0.3]) * rng.standard_normal(d)).tolist()) for i in range(n)]
    rows += [(9001, None), (9002, [0.0] * d), (9003, [float("nan")] * d), (9004, [None] + [1.0] * (d - 1)), (9005, [float("inf")] * d), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, []), (9009, (np.array(rows[0][1]) * 1e-20).tolist())]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(v, x, "z", "y") for v, x in rows], "vec_id bigint, embedding array<float>, v string, n string")


def test_links_match_brute_force(spark, monkeypatch):
    for seed, block in ((1, vectors.BLOCK), (2, 7)):
        monkeypatch.setattr(vectors, "BLOCK", block)
        rows = _rows(seed)
        got = sorted(tuple(r)[:3] for r in vectors.link(_frame(spark, rows)).collect())
        want = _brute(rows)
        assert [g[0] for g in got] == [w[0] for w in want]
        found, there = sum(g[1] for g in got), sum(w[1] for w in want)
        assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)) and found >= 0.99 * there
        assert found < there or got == want


def test_repeats_and_empty(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (1, [2.0, 0.0]), (None, [1.0, 0.0])]
    got = sorted(map(str, (tuple(r) for r in vectors.link(_frame(spark, rows)).collect())))
    assert got == sorted(map(str, [(1, 2, 1, True), (3, 2, 1, False), (3, 2, 1, False), (None, 0, None, True)]))
    assert vectors.link(_frame(spark, [])).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotated, code, factor = vectors.encode(x)
    true = x @ x.T
    middle = vectors.upper_bounds(code, factor, rotated, 0)
    off = ~np.eye(len(x), dtype=bool)
    assert abs((middle - true)[off].mean()) < 0.005
    assert (vectors.upper_bounds(code, factor, rotated) >= true - 1e-12).mean() > 0.999


def test_stated_miss_holds_in_large_plans():
    rng, d, n = np.random.default_rng(8), 64, 10_000
    x = rng.standard_normal((n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((n, d))
    z -= np.einsum("ij,ij->i", z, x)[:, None] * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = vectors.THRESHOLD * x + np.sqrt(1 - vectors.THRESHOLD**2) * z
    for rows in (2_000, 1_000_000, 100_000_000):
        bits, tables = vectors.plan(rows, d)
        missed = (vectors.bucket_keys(x, bits, tables) != vectors.bucket_keys(y, bits, tables)).all(axis=1).mean()
        assert missed < 2 * vectors.MISS


def test_packed_codes_leave_every_link_open():
    rng = np.random.default_rng(5)
    for d in (2, 3, 17, 64, 100):
        x = rng.standard_normal((4000, d))
        y = x + rng.standard_normal((4000, d)) * 0.25 * np.linalg.norm(x, axis=1, keepdims=True) / np.sqrt(d)
        x, y = (a / np.linalg.norm(a, axis=1, keepdims=True) for a in (x, y))
        cosine = (x * y).sum(axis=1)
        near = np.flatnonzero(cosine >= vectors.THRESHOLD)
        a, b = (vectors.unpack(vectors.pack(*vectors.encode(z[near])), d) for z in (x, y))
        opened = np.concatenate([vectors.may_reach(tuple(c[i : i + 500] for c in a), tuple(c[i : i + 500] for c in b), vectors.THRESHOLD).diagonal() for i in range(0, len(near), 500)])
        assert len(near) > 50 and opened.mean() > 0.999
    # Most pairs that are far apart aren't fetched.
    assert vectors.may_reach(tuple(c[:400] for c in a), tuple(c[:400] for c in a), vectors.THRESHOLD).mean() < 0.05
