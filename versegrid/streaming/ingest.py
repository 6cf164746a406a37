"""Incremental ingest: a stream of texts replaces the references of the works it brings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from .runs import Runs

CITED = "filename string, book string, book_slug string, chapter int, verse_start int, verse_end int, citation_offset int, passage_start_offset int, passage_end_offset int"


def citations_of(texts: DataFrame) -> DataFrame:
    """References with passages of (filename, text) rows; each text is read where it stands."""
    rows = texts.select(F.col("filename").alias("id"), "text")
    return windows.cited(rows).withColumnRenamed("id", "filename")


def references(spark: SparkSession, store: str, **options) -> Runs:
    """The stored references: a log-structured table by filename."""
    return Runs(spark, store, CITED, **options)


def take(store: Runs, texts: DataFrame, number: int) -> bool:
    """Batch ``number`` of texts; a batch that comes again changes nothing.

    A re-parse without citations removes the file's old ones. Null texts cite
    nothing; of a name that comes twice in a batch all rows count.
    """
    return store.append(number, citations_of(texts), texts.select("filename"))


def start(spark: SparkSession, source: str, store: str, checkpoint: str, **options):
    """Watches a folder of parquet files of (filename, text) and stores what each batch holds."""
    table = references(spark, store, **options)
    stream = spark.readStream.schema("filename string, text string").parquet(source)
    return stream.writeStream.foreachBatch(lambda rows, number: take(table, rows, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, store: str) -> DataFrame:
    """The references of each file's last batch."""
    return references(spark, store).current()
