"""Codes and balls against brute force over the awkward cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from versegrid.llm import balls, codes, integers

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, id string, error string, cluster string, code string, g_ string, distance string"
CLASH = ("c",) * 7


def _rows(n=300, d=64, seed=1, spread=0.05):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(d)] for _ in range(9)]
    rows = [(i * 3 % 1000, [float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(middles)], rng.choice([None, 0, 0, 0, 1, 2])) for i in range(n)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], 1), (None, rows[5][1], None), (5000, None, 1), (5001, [None] + rows[3][1][1:], 1), (5002, [math.nan] + rows[3][1][1:], 0), (5003, [math.inf] + rows[3][1][1:], 0), (-7, rows[9][1], 2)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


def _kept(rows, scale, d=64):
    return [(k, [math.floor(scale * x) for x in v], label) for k, v, label in rows if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]


def _best(x, centres):
    far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centres]
    return min(range(len(far)), key=lambda i: (far[i], i)), min(far)


def _moved(centres, given):
    return [[sum(col) // len(mine) for col in zip(*mine, strict=True)] if (mine := given.get(i)) else c for i, c in enumerate(centres)]


def _lloyd(vectors, centres, rounds):
    for _ in range(rounds):
        given = {}
        for x in vectors:
            given.setdefault(_best(x, centres)[0], []).append(x)
        centres = _moved(centres, given)
    return centres, [_best(x, centres) for x in vectors]


def _codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    kept = sorted(_kept(rows, scale), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    books, told = [], []
    for p in range(parts):
        cut = [r[1][p * w : p * w + w] for r in kept]
        book, best = _lloyd(cut, cut[:entries], rounds)
        books.append(book)
        told.append(best)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(told[p][i][1] for p in range(parts)) for i in range(len(kept))]
    by_label = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{told[p][i][0]:02x}" for p in range(parts)), error[i], by_label[r[2]], sha) for i, r in enumerate(kept)]


def _balls(rows, scale=64, clusters=16, rounds=3):
    kept = sorted(_kept(rows, scale), key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres, told = _lloyd([r[1] for r in kept], [r[1] for r in kept[:clusters]], rounds)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    inertia = {}
    for c, far in told:
        inertia[c] = inertia.get(c, 0) + far
    return [(r[0], c, far, inertia[c], sum(inertia.values()), shas[c]) for r, (c, far) in zip(kept, told, strict=True)]


@pytest.mark.parametrize("spread", [0.0, 0.05, 0.6])
def test_codes_equal_brute_force(spark, spread):
    rows = _rows(spread=spread)
    got = [tuple(r) for r in codes.compress(_frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, _codes(rows)))


@pytest.mark.parametrize("spread", [0.0, 0.05, 0.6])
def test_balls_equal_brute_force(spark, spread):
    rows = [*_rows(spread=spread), (6000, [0.5] * 63, 1), (6001, [], 1)]
    got = [tuple(r) for r in balls.cluster(_frame(spark, rows).repartition(5)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, _balls(rows)))


def test_few_rows_and_none(spark):
    rows = _rows(12)[:3]
    assert sorted(map(str, map(tuple, codes.compress(_frame(spark, rows)).collect()))) == sorted(map(str, _codes(rows)))
    assert sorted(map(str, map(tuple, balls.cluster(_frame(spark, rows)).collect()))) == sorted(map(str, _balls(rows)))
    for none in ([], [(1, None, 1)], [(1, [math.nan] * 64, None)]):
        assert codes.compress(_frame(spark, none)).collect() == balls.cluster(_frame(spark, none)).collect() == []
    assert codes.compress(_frame(spark, [(1, [0.5] * 12, 1)])).collect() == []
    # The least key's length counts.
    assert [r.vec_id for r in codes.compress(_frame(spark, [(2, [0.5] * 64, 1), (1, [0.5] * 16, 1)])).collect()] == [1]


def test_beyond_the_exact_range_is_an_error(spark):
    for run in (codes.compress, balls.cluster):
        with pytest.raises(Exception, match="exact range"):
            run(_frame(spark, [(1, [3e9] * 64, 1)])).collect()


def test_many_labels_take_the_salted_way(spark, monkeypatch):
    want = sorted(map(str, codes.compress(_frame(spark, _rows())).collect()))
    monkeypatch.setattr(integers, "FEW_GROUPS", 1)
    monkeypatch.setattr(integers, "SALTS", 3)
    assert sorted(map(str, codes.compress(_frame(spark, _rows())).collect())) == want


def test_balls_compare_few_pairs():
    rng = np.random.default_rng(3)
    v = np.concatenate([m + rng.integers(-6, 7, (200, 16)) for m in rng.integers(-200, 200, (12, 16))]).astype(np.int64)
    ball, cluster, made = balls.Balls(v[::200].copy()), np.zeros(len(v), np.int64), []
    for _ in range(4):
        to, far, n = ball.assign(v, cluster)
        every = ((v[:, None, :] - ball.centres[None]) ** 2).sum(2)
        assert (to == every.argmin(1)).all() and (far == every.min(1)).all()
        sums, counts = integers.summed_by(to, v, 12)
        ball, cluster = ball.after(integers.moved(ball.centres, sums, counts), np.array([far[to == a].max(initial=0) for a in range(12)])), to
        made.append(n)
    # Once clusters stand, members are stable core and cost one comparison each.
    assert made[0] > len(v) and made[-1] == len(v)


def test_ties_go_to_the_smaller_number():
    ball = balls.Balls(np.array([[4, 0], [0, 0], [2, 2], [4, 0]]))
    for start in range(4):
        to, far, _ = ball.assign(np.array([[2, 0], [4, 0], [0, 0]]), np.full(3, start))
        assert to.tolist() == [0, 0, 1] and far.tolist() == [4, 0, 0]
