"""A log-structured table: batches are runs, runs of one size are merged into a larger one.

A run holds the rows that a batch brought and the keys it has seen, a key
without rows included; a key's last run holds all its rows. Both are stored
bucketed and sorted by key, so that runs meet bucket by bucket without a
shuffle, be it to be merged or to be read. A level takes ``fanout`` runs; then
they become one of the next level, without the rows that a later one of them
replaces. So a row is rewritten once a level, and n batches leave at most
``fanout`` times log n runs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.storage import Versions, named, remove

BUCKETS, FANOUT = 16, 4


class Runs:
    """The table in a folder; ``schema`` is that of its rows, with the key first. Buckets are fixed once it has runs."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, *, buckets: int = BUCKETS, fanout: int = FANOUT):
        self.spark, self.folder, self.buckets, self.fanout = spark, folder.rstrip("/"), buckets, fanout
        self.schema = StructType.fromDDL(schema)
        self.key = self.schema[0].name
        self.versions = Versions(spark, folder)

    def state(self) -> dict:
        return self.versions.last()[1] or {"applied": -1, "buckets": self.buckets, "runs": []}

    # Runs on disk -----------------------------------------------------------------------------------------------

    def _write(self, rows: DataFrame, path: str, buckets: int) -> None:
        # The hash of the buckets is that of the shuffle, so each bucket is one file.
        dealt = rows.repartition(buckets, self.key)
        table = f"run_{uuid.uuid4().hex}"
        dealt.write.mode("overwrite").bucketBy(buckets, self.key).sortBy(self.key).option("path", path).option("compression", "zstd").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")

    def _read(self, path: str, schema: StructType, buckets: int) -> DataFrame:
        """The files as a bucketed table; a session's catalog has it for as long as the plan is made."""
        table = f"run_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        rows = self.spark.table(table)
        rows.schema  # the plan is resolved here; dropping an external table leaves its files
        self.spark.sql(f"DROP TABLE {table}")
        return rows

    def _parts(self, run: dict, buckets: int) -> tuple[DataFrame, DataFrame]:
        """(rows, seen) of a run."""
        path = f"{self.folder}/runs/{run['name']}"
        return self._read(f"{path}/rows", self.schema, buckets), self._read(f"{path}/seen", StructType([self.schema[0]]), buckets)

    def _standing(self, parts: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
        """The rows of runs, oldest first, that no later one of them replaces."""
        out = []
        for i, (rows, _) in enumerate(parts):
            for _, seen in parts[i + 1 :]:
                rows = rows.join(seen, self.key, "left_anti")
            out.append(rows.select(*self.schema.names))
        return reduce(DataFrame.unionByName, out)

    # The table --------------------------------------------------------------------------------------------------

    def append(self, number: int, rows: DataFrame, seen: DataFrame) -> bool:
        """Batch ``number``: ``seen`` are its keys, ``rows`` all rows of theirs. False where the batch is in already.

        Batches come in order of their numbers; one that runs again after a
        failure writes its run anew, or finds it applied.
        """
        state = self.state()
        if number <= state["applied"]:
            return False
        run = {"name": f"{number:09d}-0", "level": 0, "low": number, "high": number}
        path = f"{self.folder}/runs/{run['name']}"
        self._write(rows.select(*self.schema.names), f"{path}/rows", state["buckets"])
        self._write(seen.select(self.key).distinct(), f"{path}/seen", state["buckets"])
        self._put(state | {"applied": number, "runs": [*state["runs"], run]})
        self.merge()
        return True

    def _put(self, state: dict) -> None:
        self.versions.put(self.versions.last()[0] + 1, state)

    def merge(self, whole: bool = False) -> None:
        """Merge levels that are full, from the least; all runs into one where ``whole`` is set."""
        while True:
            state = self.state()
            runs = state["runs"]
            levels = sorted({r["level"] for r in runs})
            full = [level for level in levels if sum(r["level"] == level for r in runs) >= self.fanout]
            if whole:
                mine = runs if len(runs) > 1 else []
            else:
                mine = [r for r in runs if full and r["level"] == full[0]]
            if not mine:
                return
            level, last = max(r["level"] for r in mine) + 1, mine[-1]["high"]
            run = {"name": f"{last:09d}-{level}", "level": level, "low": mine[0]["low"], "high": last}
            path, parts = f"{self.folder}/runs/{run['name']}", [self._parts(r, state["buckets"]) for r in mine]
            self._write(self._standing(parts), f"{path}/rows", state["buckets"])
            self._write(reduce(DataFrame.union, [seen for _, seen in parts]).distinct(), f"{path}/seen", state["buckets"])
            at = runs.index(mine[0])
            self._put(state | {"runs": [*runs[:at], run, *runs[at + len(mine) :]]})

    def current(self) -> DataFrame:
        """The rows that stand."""
        state = self.state()
        if not state["runs"]:
            return self.spark.createDataFrame([], self.schema)
        return self._standing([self._parts(r, state["buckets"]) for r in state["runs"]])

    def vacuum(self) -> list[str]:
        """Remove the runs that the last state doesn't name; nobody may be reading an older one."""
        live = {r["name"] for r in self.state()["runs"]}
        gone = [n for n in named(self.spark, f"{self.folder}/runs/*") if n not in live]
        for n in gone:
            remove(self.spark, f"{self.folder}/runs/{n}")
        return gone
