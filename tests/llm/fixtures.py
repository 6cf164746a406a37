"""Small document tables with the awkward cases."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # Extra columns whose names the operators use inside.
    StructField("size", StringType()), StructField("h", StringType()), StructField("hash", StringType()), StructField("key", StringType()),
])


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(d, t, l, s, None if t is None else len(t), "x", "y", "z", "k") for d, t, l, s in full], DOCS)
