from versegrid.llm import mixing

from .fixtures import documents


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Brute force: cap, reshare, repeat."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        pool = total - sum(most * sizes[s] for s in capped)
        out = {s: most * sizes[s] for s in capped} | {s: pool * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if out[s] > most * sizes[s]}
        if not over:
            return out
        capped |= over


def test_targets_and_budgets(spark):
    rows = [(i, "w " * (i * 37 % 50), "en", f"s{i % 5}" if i % 11 else None) for i in range(400)]
    rows += [(1000 + i, "a b c", "en", "tiny") for i in range(2)] + [(2000, None, None, None), (2001, "", None, "s1"), (2002, "x y", None, "s1"), (2002, "x y", None, "s1")]
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    want = _targets(sizes)
    for s, size in sizes.items():
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == size and abs(r.target - want[s]) < 1e-6 for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(r["size"] for r in mine)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    again = mixing.mix(documents(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_empty_and_wordless(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    got = mixing.mix(documents(spark, [(1, None), (2, ""), (None, " ")])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0)] * 3


def test_many_sources_take_the_salted_way(spark, monkeypatch):
    rows = [(i, "w " * (i * 31 % 23), "en", f"s{i % 7}" if i % 5 else None) for i in range(200)]
    want = sorted(map(str, mixing.mix(documents(spark, rows)).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    monkeypatch.setattr(mixing, "SALTS", 3)
    assert sorted(map(str, mixing.mix(documents(spark, rows)).collect())) == want


def test_rows_that_share_an_id_meet_their_targets(spark):
    same = [(1, "w " * 5, "en", f"s{i % 3}") for i in range(3000)]
    versions = [(None, f"v{i} w w w w", "en", f"s{i % 3}") for i in range(3000)]
    for rows in (same, versions, same + versions):
        got = mixing.mix(documents(spark, rows)).collect()
        sizes = {f"s{k}": sum(r["size"] for r in got if r.source == f"s{k}") for k in range(3)}
        want = _targets(sizes)
        for s in sizes:
            assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 5
        assert all(0 <= r.taken <= 3 * r["size"] for r in got)
        assert sorted(map(str, mixing.mix(documents(spark, rows[::-1])).collect())) == sorted(map(str, got))
