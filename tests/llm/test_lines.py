"""Line dedup against brute force, and documents that come and go."""

import hashlib
import os
import random
import shutil

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from versegrid.llm import lines
from versegrid.llm.lines import Cuckoo, Index

SCHEMA = "doc_id bigint, text string, row string, doc string, body string, gone string, k1 string, shard string, kept string"


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, *("c",) * 7) for d, t in rows], SCHEMA)


def _key(line):
    return line.encode().strip(b" \t\n\x0b\x0c\r").lower().decode()


def _brute(rows):
    by = lambda d: (1 << 63) - 1 if d is None else d
    docs = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(_key(line)) >= 10:
                docs.setdefault(_key(line), set()).add(by(d))
    out = []
    for d, t in rows:
        all_ = (t or "").split("\n")
        left = [x for x in all_ if not (len(held := docs.get(_key(x), ())) > 1 and by(d) != min(held))]
        out.append((d, len(all_), len(all_) - len(left), "\n".join(left)))
    return sorted(map(str, out))


def _got(kept):
    return sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in kept.collect())


def _rows(n, seed, first=0):
    rng = random.Random(seed)
    pool = [f"line {i} of the pool" for i in range(40)] + ["short", "", "   ", "é" * 9, "é" * 10, "  Spaced Out Line \t", "spaced out line", "SPACED OUT LINÉ", "spaced out linÉ", "a\x0bb " * 4, "hot line everywhere"]
    rows = []
    for i in range(n):
        said = [rng.choice(pool) if rng.random() < 0.6 else f"own line {seed} {i} {j}" for j in range(rng.randrange(8))]
        rows.append((first + i, "\n".join([*said, "hot line everywhere"] if i % 3 else said)))
    return rows


ODD = [(None, "line 1 of the pool\nnull doc's own line"), (None, "null doc's own line"), (7, None), (8, ""), (9, "\n\n"), (3, "line 1 of the pool\nversion"), (3, "line 1 of the pool\nversion"), (10_000, "twice in one text\ntwice in one text"), (10_001, "Twice in one text\r\n twice in one TEXT")]


def test_equals_brute_force(spark):
    rows = [*_rows(200, 1), *ODD]
    assert _got(lines.deduplicate(_frame(spark, rows).repartition(3))) == _brute(rows)
    assert lines.deduplicate(_frame(spark, [])).collect() == []
    told = lines.digest(lines.deduplicate(_frame(spark, [(1, "a\nb")]))).first()
    assert tuple(told) == (1, 2, 0, hashlib.sha256(b"a\nb").hexdigest())


def test_sql_equals_brute_force(spark):
    documents = _frame(spark, [*_rows(60, 4), *ODD]).select("doc_id", "text").toPandas().astype({"doc_id": "Int64"})  # noqa: F841 - DuckDB reads it
    want = sorted(map(str, map(tuple, lines.digest(lines.deduplicate(_frame(spark, [*_rows(60, 4), *ODD]))).collect())))
    assert sorted(map(str, duckdb.sql(lines.DIGEST_SQL).fetchall())) == want


def test_long_texts(spark):
    long = "\n".join(f"line number {i}" for i in range(40_000))
    rows = [(2, long + "\nend of two"), (1, long), (3, "x" * 2_000_000), (4, "x" * 2_000_000)]
    assert _got(lines.deduplicate(_frame(spark, rows))) == _brute(rows)


def test_documents_come_and_go(spark, tmp_path, bits=3):
    """After every change the index tells what a fresh one over the live documents tells."""
    index, live = Index(spark, str(tmp_path / "index"), bits=bits, salts=3), []
    changes = [("+", _rows(60, 1, 100)), ("+", [*_rows(60, 2, 50), *ODD]), ("-", [50, 51, 60, 100, 101, 102, 150, None, 77_777]), ("+", _rows(30, 1, 0)), ("-", list(range(0, 120))), ("+", _rows(20, 1, 100))]
    for kind, what in changes:
        if kind == "+":
            index.insert(_frame(spark, what))
            live += what
        else:
            index.delete(spark.createDataFrame([(d,) for d in what], "doc_id bigint"))
            live = [r for r in live if r[0] not in what]
        assert _got(index.kept(_frame(spark, live))) == _brute(live)
        # The filters hold each live key once or twice, and nothing else.
        held = sum(int((np.frombuffer(r.blob, np.uint16) != 0).sum()) for r in index.filters().collect())
        keys = {}
        for d, t in live:
            for line in (t or "").split("\n"):
                if len(_key(line)) >= 10:
                    keys.setdefault(_key(line), set()).add(d)
        assert held == sum(min(2, len(k)) for k in keys.values())
    index.delete(spark.createDataFrame([(d,) for d, _ in live], "doc_id bigint"))
    assert index.live().count() == 0 and all(not any(r.blob) for r in index.filters().collect())


def test_a_change_that_broke_off_counts_for_nothing(spark, tmp_path):
    index = Index(spark, str(tmp_path / "index"))
    first = _rows(40, 1)
    index.insert(_frame(spark, first))
    index.insert(_frame(spark, _rows(40, 2, 1000)))
    shutil.rmtree(tmp_path / "index" / "commits" / "version=2")
    assert index.versions() == [1] and _got(index.kept(_frame(spark, first))) == _brute(first)
    more = _rows(40, 3, 500)
    index.insert(_frame(spark, more))
    assert sorted(os.listdir(tmp_path / "index" / "references")) == ["version=1", "version=2"]
    assert _got(index.kept(_frame(spark, first + more))) == _brute(first + more)


def test_known_keys_and_false_ones(spark, tmp_path):
    index = Index(spark, str(tmp_path / "index"))
    mine = index.insert(_frame(spark, _rows(100, 1))).select("k1", "k2").distinct()
    assert index.known(mine).count() == mine.count()
    others = spark.range(20_000).select(F.xxhash64("id").alias("k1"), F.xxhash64("id", F.lit(1)).alias("k2"))
    assert index.known(others).count() < 20


@pytest.mark.parametrize("bits,n", [(5, 90), (5, 400), (10, 3500), (10, 9000)])
def test_filters_lose_nothing(bits, n):
    told, h = Cuckoo(bits), np.random.default_rng(n).integers(-(2**63), 2**63 - 1, n)
    told.add(h)
    told.add(np.concatenate((h[: n // 2], h[:3], h[:3], h[:3])))
    assert (told.count(h) >= 1).all() and (told.count(h[: n // 2]) >= 2).all() and (told.count(h[:3]) >= 5).all()
    told = Cuckoo.of(told.rows(), bits)
    told.take(np.concatenate((h[:3], h[:3], h[:3], h[n // 3 : n // 2])))
    assert (told.count(h) >= 1).all() and (told.count(h[: n // 3]) >= 2).all()
    told.take(np.concatenate((h, h[: n // 3])))
    assert not any(p.any() for p in told.parts)
    with pytest.raises(ValueError, match="never"):
        told.take(h[:1])
