"""Staged builds: slices, clean builds, broken ones, and places."""

import os
import random

import pytest

from versegrid.operators.places import numbered
from versegrid.sources.outputs import Output


def _rows(spark, **keys):
    return spark.createDataFrame([(k, n) for k, ns in keys.items() for n in ns], "book_slug string, n int")


def _held(output):
    return sorted(tuple(r) for r in output.current().select("book_slug", "n").collect())


def test_builds_in_stages(spark, tmp_path):
    output = Output(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        output.current()
    assert sorted(map(tuple, output.reconciled(_rows(spark, a=[1])).collect())) == [("a", "missing")]
    output.draft().stage(_rows(spark, a=[1, 2], b=[3], **{"x y/ü+%": [9]})).publish()
    assert _held(output) == [("a", 1), ("a", 2), ("b", 3), ("x y/ü+%", 9)]
    # A slice leaves the others alone, and a draft that is never published changes nothing.
    output.draft().stage(_rows(spark, a=[7])).publish()
    output.draft().stage(_rows(spark, a=[8], b=[8]))
    assert _held(output) == [("a", 7), ("b", 3), ("x y/ü+%", 9)]
    assert sorted(map(tuple, output.reconciled(_rows(spark, a=[1], c=[1])).collect())) == [("a", "built"), ("b", "stale"), ("c", "missing"), ("x y/ü+%", "stale")]
    # Files on disk are more than count; a sweep leaves those that do.
    assert output.files().count() == 6 and output.sweep() == 2
    assert sorted(r.book_slug for r in output.files().collect()) == ["a", "b", "x y/ü+%"] and _held(output) == [("a", 7), ("b", 3), ("x y/ü+%", 9)]
    # Stages of one draft replace their own keys alone.
    draft = output.draft().stage(_rows(spark, b=[1], c=[1]))
    draft.stage(_rows(spark, c=[2, 3])).publish(clean=True)
    assert _held(output) == [("b", 1), ("c", 2), ("c", 3)]
    output.sweep()
    assert sorted(r.book_slug for r in output.files().collect()) == ["b", "c"]
    output.draft().stage(_rows(spark)).publish()
    assert len(_held(output)) == 3
    output.draft().stage(_rows(spark)).publish(clean=True)
    with pytest.raises(FileNotFoundError):
        output.current()
    output.draft().stage(_rows(spark, a=[5])).publish()
    assert _held(output) == [("a", 5)]


def test_a_build_that_breaks_off_leaves_the_output(spark, tmp_path, monkeypatch):
    output = Output(spark, str(tmp_path))
    output.draft().stage(_rows(spark, a=[1], b=[2])).publish()
    for step in ("keys", "staged"):
        draft = output.draft().stage(_rows(spark, a=[9]))
        monkeypatch.setattr(draft, step, lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            draft.publish(clean=True)
        assert _held(Output(spark, str(tmp_path))) == [("a", 1), ("b", 2)]
    # The table is written, its state isn't.
    draft = output.draft().stage(_rows(spark, a=[9]))
    monkeypatch.setattr(output.versions, "put", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        draft.publish(clean=True)
    again = Output(spark, str(tmp_path))
    assert _held(again) == [("a", 1), ("b", 2)]
    again.sweep()
    assert len(os.listdir(tmp_path / "tables")) == 1 and len([n for n in os.listdir(tmp_path / "parts") if n.startswith("draft")]) == 1
    draft.discard()
    with pytest.raises(ValueError, match="staged"):
        again.draft().publish()


def test_only_the_files_that_count_are_read(spark, tmp_path):
    output = Output(spark, str(tmp_path))
    output.draft().stage(_rows(spark, a=[1], b=[2])).publish()
    output.draft().stage(_rows(spark, a=[3])).publish()
    plan = output.current()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_places(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(50)) for _ in range(500)]
    got = numbered(spark.createDataFrame(rows, "s string, n int").repartition(7), ["s", "n"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.s, r.n) for r in sorted(got, key=lambda r: r.place)] == want and sorted(r.place for r in got) == list(range(1, 501))
    assert numbered(spark.createDataFrame([], "n int"), ["n"]).collect() == []
