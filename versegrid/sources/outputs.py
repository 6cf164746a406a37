"""Built files by key, replaced in stages: a build is drafted, compared with what is wanted, and put in place at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.storage import Versions, named, remove


class Output:
    """Files of rows in a folder, partitioned by a key such as the book.

    ``parts`` holds drafts, each a folder of partitions; ``tables`` holds which
    draft each key's files are of, a row a key; a state names a table. Readers
    see the table of the last state, so a build that breaks off at any point
    leaves the output as it was.
    """

    def __init__(self, spark: SparkSession, folder: str, by: str = "book_slug"):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), by
        self.versions = Versions(spark, folder)

    def state(self) -> dict:
        return self.versions.last()[1] or {"table": None, "schema": None, "drafts": []}

    def table(self) -> DataFrame:
        """(key, draft) of every key that has files."""
        schema = f"`{self.by}` string, draft string"
        told = self.state()["table"]
        return self.spark.read.schema(schema).parquet(f"{self.folder}/tables/{told}") if told else self.spark.createDataFrame([], schema)

    def draft(self) -> Draft:
        return Draft(self, uuid.uuid4().hex)

    def current(self) -> DataFrame:
        """The rows of the output."""
        state = self.state()
        if not state["drafts"]:
            raise FileNotFoundError(f"nothing has been built in {self.folder}")
        schema = StructType.fromJson(state["schema"]).add("draft", "string").add(self.by, "string")
        rows = self.spark.read.schema(schema).option("basePath", f"{self.folder}/parts").parquet(*[f"{self.folder}/parts/draft={d}" for d in state["drafts"]])
        # Only partitions are compared, so files that no longer count are not read; the filter, which all keys pass, lets the planner prune.
        return rows.join(self.table().where(F.col("draft").isin(state["drafts"])), ["draft", self.by], "left_semi").drop("draft")

    def _listed(self) -> DataFrame:
        """key, draft, folder, length of each file on disk; contents are not read."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{self.folder}/parts")
        at = rf"^(.*/draft=([^/]+)/{self.by}=([^/]+))/[^/]+$"
        # The writer escapes keys by percents; a plus is a plus.
        key = F.url_decode(F.replace(F.regexp_extract("path", at, 3), F.lit("+"), F.lit("%2B")))
        return found.select(key.alias(self.by), F.regexp_extract("path", at, 2).alias("draft"), F.regexp_extract("path", at, 1).alias("folder"), "length")

    def files(self) -> DataFrame:
        """key, draft, files, bytes of all partitions on disk, by listing alone."""
        return self._listed().groupBy(self.by, "draft").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))

    def reconciled(self, wanted: DataFrame) -> DataFrame:
        """key, state of all keys: ``missing`` (wanted, without files), ``stale`` (files that nobody wants), ``built``."""
        want = wanted.select(F.col(self.by).cast("string")).distinct().withColumn("w", F.lit(True))
        both = self.table().withColumn("b", F.lit(True)).join(want, self.by, "full_outer")
        return both.select(self.by, F.when(F.col("b").isNull(), "missing").when(F.col("w").isNull(), "stale").otherwise("built").alias("state"))

    def sweep(self) -> int:
        """Remove files that the last state doesn't name: broken drafts and replaced keys. Nobody may be reading an older state."""
        state = self.state()
        gone = [n for n in named(self.spark, f"{self.folder}/parts/draft=*") if n.split("=", 1)[1] not in state["drafts"]]
        for n in gone:
            remove(self.spark, f"{self.folder}/parts/{n}")
        for n in named(self.spark, f"{self.folder}/tables/*"):
            if n != state["table"]:
                remove(self.spark, f"{self.folder}/tables/{n}")
        count = len(gone)
        if state["drafts"]:
            # One folder at a time, as they come from the executors.
            old = self._listed().join(self.table(), ["draft", self.by], "left_anti").select("folder").distinct()
            for r in old.toLocalIterator():
                remove(self.spark, r["folder"])
                count += 1
        return count


class Draft:
    """A build that nobody sees yet."""

    def __init__(self, output: Output, name: str):
        self.output, self.name, self.schema = output, name, None
        self.path = f"{output.folder}/parts/draft={name}"

    def stage(self, rows: DataFrame) -> Draft:
        """Write the partitions of the keys in ``rows``; those that were staged before and are not in it stay.

        Rows are dealt by key, and a large key over several tasks. Rows without
        a key have no files.
        """
        by = self.output.by
        dealt = rows.where(F.col(by).isNotNull()).withColumn(by, F.col(by).cast("string")).hint("rebalance", by)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(by).parquet(self.path)
        self.schema = rows.drop(by).schema
        return self

    def keys(self) -> DataFrame:
        by = self.output.by
        return self.output.spark.read.schema(f"`{by}` string").parquet(self.path).select(by).distinct() if self.staged() else self.output.spark.createDataFrame([], f"`{by}` string")

    def staged(self) -> bool:
        return bool(named(self.output.spark, f"{self.path}/{self.output.by}=*"))

    def publish(self, *, clean: bool = False) -> None:
        """The staged keys replace theirs in the output; ``clean`` drops all others. Takes effect at once or not at all."""
        if self.schema is None:
            raise ValueError("nothing was staged")
        out, by = self.output, self.output.by
        number, _ = out.versions.last()
        mine = self.keys().withColumn("draft", F.lit(self.name))
        table = mine if clean else out.table().join(mine.select(by), by, "left_anti").select(by, "draft").unionByName(mine)
        name = f"{number + 1:09d}-{self.name}"
        table.write.parquet(f"{out.folder}/tables/{name}")
        drafts = sorted(r.draft for r in out.spark.read.parquet(f"{out.folder}/tables/{name}").select("draft").distinct().collect())
        out.versions.put(number + 1, {"table": name, "schema": self.schema.jsonValue(), "drafts": drafts})

    def discard(self) -> None:
        remove(self.output.spark, self.path)
