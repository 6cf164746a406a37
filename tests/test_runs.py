"""The log-structured table: any order of batches, merges and failures gives the rows of each key's last batch."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from versegrid.functions.storage import Versions, put_once
from versegrid.streaming.runs import Runs

SCHEMA = "name string, n int"


def _batch(spark, rows):
    """{name: numbers} as (rows, seen)."""
    return spark.createDataFrame([(k, x) for k, xs in rows.items() for x in xs], SCHEMA), spark.createDataFrame([(k,) for k in rows] * 2, "name string")


def _state(table):
    return sorted((r.name, r.n) for r in table.current().collect())


def test_last_batch_of_each_key_stands(spark, tmp_path):
    rng, table, want = random.Random(1), Runs(spark, str(tmp_path), SCHEMA, buckets=3, fanout=2), {}
    assert _state(table) == []
    for number in range(9):
        batch = {f"k{rng.randrange(12)}": [rng.randrange(100) for _ in range(rng.randrange(4))] for _ in range(5)}
        assert table.append(number, *_batch(spark, batch))
        want |= batch
        assert _state(table) == sorted((k, x) for k, xs in want.items() for x in xs)
        # Runs as the number's digits have it, the largest first.
        assert [r["level"] for r in table.state()["runs"]] == [i for i in range(8, -1, -1) if (number + 1) >> i & 1]
    assert not table.append(3, *_batch(spark, {"k1": [-1]})) and not table.append(8, *_batch(spark, {"k1": [-1]}))
    before = _state(table)
    table.merge(whole=True)
    assert _state(table) == before and len(table.state()["runs"]) == 1
    # The one run that is left holds the rows that stand, and nothing else is on disk.
    gone = table.vacuum()
    assert gone and _state(table) == before and len(os.listdir(tmp_path / "runs")) == 1
    rows = spark.read.parquet(str(tmp_path / "runs" / table.state()["runs"][0]["name"] / "rows"))
    assert rows.count() == len(before)


def test_runs_meet_without_a_shuffle(spark, tmp_path):
    table = Runs(spark, str(tmp_path), SCHEMA, buckets=4, fanout=9)
    for number in range(3):
        table.append(number, *_batch(spark, {f"k{i}": [number] for i in range(number, 9)}))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = table.current()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert _state(table) == [("k0", 0), ("k1", 1), *((f"k{i}", 2) for i in range(2, 9))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_what_broke_off_counts_for_nothing(spark, tmp_path):
    table = Runs(spark, str(tmp_path), SCHEMA, buckets=2, fanout=2)
    table.append(0, *_batch(spark, {"a": [1], "b": [2]}))
    # A run without its state, as a writer leaves it that breaks off; the batch comes again with other rows.
    shutil.copytree(tmp_path / "runs" / "000000000-0", tmp_path / "runs" / "000000001-0")
    assert _state(table) == [("a", 1), ("b", 2)]
    assert table.append(1, *_batch(spark, {"b": []}))
    assert _state(table) == [("a", 1)] == _state(Runs(spark, str(tmp_path), SCHEMA, buckets=7))
    # A merge without its state.
    versions = Versions(spark, str(tmp_path))
    os.remove(tmp_path / "states" / f"{versions.last()[0]:09d}.json")
    assert _state(table) == [("a", 1)] and len(table.state()["runs"]) == 2
    table.merge()
    assert _state(table) == [("a", 1)] and len(table.state()["runs"]) == 1


def test_a_state_is_put_once(spark, tmp_path):
    put_once(spark, str(tmp_path / "x"), "é")
    with pytest.raises(FileExistsError):
        put_once(spark, str(tmp_path / "x"), "b")
    assert (tmp_path / "x").read_text() == "é" and not [f for f in os.listdir(tmp_path) if f.endswith(".draft")]


def test_stored_types_come_back(spark, tmp_path):
    table = Runs(spark, str(tmp_path), "name string, at struct<x:int,y:array<string>>, d double")
    rows = spark.range(3).select(F.lit("a").alias("name"), F.struct(F.lit(1).alias("x"), F.array(F.lit("q")).alias("y")).alias("at"), F.lit(0.5).alias("d"))
    table.append(0, rows, rows)
    assert table.current().schema.simpleString() == rows.schema.simpleString() and table.current().count() == 3
