"""Materialised steps in the folder that driver and executors share, and folders of numbered states."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in local mode a temporary one where that is unset.

    On a cluster a folder of the driver's machine would not be shared, so a
    session without the setting is refused there.
    """
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once and stored reliably in the shared folder, so that lost executors lose nothing of it.

    Its files stay until the folder is cleared, or until nothing refers to them
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    spark = df.sparkSession
    where = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def _at(spark: SparkSession, path: str):
    """(file system, path) of a path that Spark can read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def named(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what matches a pattern of paths, in order."""
    fs, place = _at(spark, pattern)
    return sorted(s.getPath().getName() for s in fs.globStatus(place) or ())


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there in whole or not at all; an error where it is there already."""
    fs, place = _at(spark, path)
    _, draft = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise FileExistsError(path)


class Versions:
    """Numbered states of a folder, each a small JSON file that is put in place by one rename; the last one counts.

    What a state names is written before it. A writer that breaks off leaves
    files that no state names, and the state before stands. The folder must be
    on a store whose renames are atomic.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/states"

    def last(self) -> tuple[int, dict]:
        """(number, state); (0, {}) at first."""
        names = named(self.spark, f"{self.folder}/*.json")
        if not names:
            return 0, {}
        return int(names[-1].split(".")[0]), json.loads(read_text(self.spark, f"{self.folder}/{names[-1]}"))

    def put(self, number: int, state: dict) -> None:
        put_once(self.spark, f"{self.folder}/{number:09d}.json", json.dumps(state))
