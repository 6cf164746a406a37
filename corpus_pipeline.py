"""A training-data pipeline over ``documents``: identify, deduplicate, decontaminate, redact, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versegrid.llm import decontaminate, language, mixing, neardup, secrets
from versegrid.llm.common import discard, scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Percent of shared shingles from which texts are near copies here; op10 has its own threshold.
NEAR = 80


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others get the language that they lack.

    Null texts, texts without a letter and, where no row has a language, all
    documents are rejected; repeated rows are judged alike and stay repeated;
    columns beyond COLUMNS go.
    """
    told = language.identify(docs, language.fit(docs), carry=COLUMNS).where(~F.col("rejected"))
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id; repeated rows stay once.

    Groups are told by row, so versions under one id count each for itself, and
    documents without an id take part, behind all others. Null and wordless
    texts stay; an empty table stays empty; columns beyond COLUMNS go.
    """
    return neardup.one_of_each(docs, threshold=NEAR).select(*COLUMNS)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents of which they are most go.

    Null texts stay null; repeated rows and ids are cut alike; empty tables
    change nothing; columns beyond COLUMNS go.
    """
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS)
    return _recounted(decontaminate.cleaned(found))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a marker; base spans always, others where few owners have them.

    Null texts stay null; repeated rows are redacted alike; null sources are
    one owner; columns beyond COLUMNS go.
    """
    found = secrets.scan(docs, carry=COLUMNS, narrow=False)
    return _recounted(found.withColumn("text", secrets.redact(F.col("text"), F.concat("base", "live"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often it takes each.

    Null sources are one source; rows that share an id move together; texts
    without words weigh nothing and are taken with their source's whole
    copies; an empty table stays empty.
    """
    mixed = mixing.mix(docs, carry=COLUMNS)
    return mixed.where("copies > 0").select(*COLUMNS, "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmarks),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]

#: The first two stages have no SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder, reread, and removed once the next stands."""
    docs, before = table(spark, sf_dir, "documents"), None
    for n, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"pipeline-{n}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
