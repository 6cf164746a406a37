"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Each language has several centroids, found by spherical k-means over its
sampled training texts; a text takes the language of the centroid with the
highest cosine. A text whose best cosine is far below what the language's own
training texts reach is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut

#: Hashed n-gram dimensions, n-gram lengths in bytes, centroids a language.
DIMENSIONS, GRAMS, CENTROIDS = 1 << 13, (1, 2, 3), 3
#: Labelled rows that the classifier is fitted on, a language at most (about); every language is fitted.
TRAIN_ROWS = 400
#: Languages whose sizes are broadcast, and salts that split a language's rows beyond that.
FEW_LANGUAGES, SALTS = 10_000, 64
#: Rejection: below this share of the cosine that all but one in a hundred training texts of the language reach.
REJECT_SHARE = 0.5
UNKNOWN = "und"


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x DIMENSIONS n-gram counts of whole texts; runs of non-letters are one space."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMENSIONS), np.float32)
    low = K.LOWER[data]
    letter = _LETTER[low]
    # Keep letters and the first byte of each other run, as a space, within a row.
    first = np.zeros(len(low), bool)
    first[1:] = letter[:-1]
    starts = offsets[:-1][offsets[:-1] < len(low)]
    first[starts] = True
    keep = letter | first
    row = np.repeat(np.arange(n), np.diff(offsets))[keep]
    x = np.where(letter, low, 32).astype(np.uint32)[keep]
    for k in GRAMS:
        if len(x) < k:
            continue
        m = len(x) - k + 1
        h = x[:m].copy()
        for i in range(1, k):
            h = h * np.uint32(0x01000193) ^ x[i : i + m]
        h = (h * np.uint32(0x9E3779B1) + np.uint32(k)) * np.uint32(0x85EBCA6B)
        bucket = (h >> np.uint32(32 - 13)).astype(np.int64)
        same = row[:m] == row[k - 1 :]
        out += np.bincount((row[:m] * DIMENSIONS + bucket)[same], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    return out


_LETTER = K._table((0x61, 0x7A), (0x80, 0xFF))


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(tf) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    #: Language of each centroid, and the cosine below which a text is rejected.
    languages: list[str]
    floor: np.ndarray

    def predict(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best centroid and its cosine."""
        cos = weighted(tf, self.idf) @ self.centroids.T
        best = cos.argmax(axis=1)
        return best, cos[np.arange(len(best)), best]


def _cluster(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means; starts from texts far from those chosen before."""
    chosen = [0]
    near = x @ x[0]
    for _ in range(1, min(k, len(x))):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        mine = (x @ c.T).argmax(axis=1)
        c = np.array([x[mine == i].sum(axis=0) if (mine == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def training_sample(docs: DataFrame, key: str, text: str, lang: str, rows: int) -> DataFrame:
    """About ``rows`` distinct labelled training texts of each language, one at least, chosen by a hash of the text, whatever its size.

    Copies count once, so neither rows that share an id nor those that share a
    text can crowd out a language, or fill it.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key))).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), (F.pmod(F.xxhash64(F.col(text), F.lit("sample")), F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("h")
    )
    sizes = cut(labelled.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")))
    # A language's share lets about ``rows`` of its texts through; shares are doubles, so none is rounded to nothing.
    fits = sampled(F.col("h"), F.col("n"), rows) | (F.col("h") == F.col("least"))
    if sizes.count() <= FEW_LANGUAGES:
        some = labelled.join(F.broadcast(sizes), "lang").where(fits)
    else:
        salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        some = labelled.withColumn("salt", F.floor(F.col("h") * SALTS).cast("int")).join(salted, ["lang", "salt"]).where(fits)
    return some.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def sampled(h: Column, n: Column, rows: int) -> Column:
    """Whether a row with hash ``h`` (0 to 1) is among the about ``rows`` of ``n``."""
    return h < F.lit(float(rows)) / n


def _by_language(batches):
    """(language, n-gram counts of its texts) of rows that are sorted by language."""
    now, rows = None, []
    for batch in batches:
        for lang, at, tf in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if lang != now:
                if rows:
                    yield now, np.array(rows)
                now, rows = lang, []
            rows.append(np.zeros(DIMENSIONS, np.float32))
            rows[-1][np.frombuffer(at, np.int32)] = np.frombuffer(tf, np.float32)
    if rows:
        yield now, np.array(rows)


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample (``rows`` labelled texts a language); languages are clustered on the executors."""

    def vectors(batches):
        for batch in batches:
            data, offsets = K.text_bytes(batch.column(1))
            for a, b in K.passes(offsets, 1 << 18):
                tf = counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = [np.flatnonzero(x) for x in tf]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.string()), pa.array([x.astype(np.int32).tobytes() for x in at], pa.binary()), pa.array([tf[i, x].tobytes() for i, x in enumerate(at)], pa.binary())], names=["lang", "at", "tf"])

    def frequencies(batches):
        for lang, tf in _by_language(batches):
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([np.mean(tf > 0, axis=0).tobytes()], pa.binary())], names=["lang", "df"])

    def clusters(batches):
        for lang, tf in _by_language(batches):
            x = weighted(np.array(sorted(tf, key=lambda v: v.tobytes())), idf)
            c = _cluster(x, CENTROIDS)
            reach = float(np.quantile((x @ c.T).max(axis=1), 0.01))
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([c.astype(np.float32).tobytes()], pa.binary()), pa.array([reach])], names=["lang", "c", "reach"])

    got = training_sample(docs, key, text, lang, rows).mapInArrow(vectors, "lang string, at binary, tf binary").where(F.length("at") > 0)
    got = cut(got.repartition("lang").sortWithinPartitions("lang"))
    # Each language counts alike in the document frequencies.
    df, n = np.zeros(DIMENSIONS), 0
    for r in got.mapInArrow(frequencies, "lang string, df binary").toLocalIterator():
        df, n = df + np.frombuffer(r["df"], np.float64), n + 1
    if not n:
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(0))
    idf = np.log(1 + 1 / (df / n + 1e-3)).astype(np.float32)
    centroids, languages, floor = [], [], []
    for r in sorted(got.mapInArrow(clusters, "lang string, c binary, reach double").toLocalIterator(), key=lambda r: r["lang"]):
        c = np.frombuffer(r["c"], np.float32).reshape(-1, DIMENSIONS)
        centroids.append(c)
        languages.extend([r["lang"]] * len(c))
        floor.extend([REJECT_SHARE * r["reach"]] * len(c))
    return Model(idf, np.concatenate(centroids), languages, np.array(floor))


def identify(docs: DataFrame, model: Model, *, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``carry`` columns of each row and lang_pred, score, rejected.

    Null texts and texts without a letter are ``und`` with score 0 and
    rejected, as is every text under a model of no languages; the score is the
    cosine of the nearest centroid, from 0 to 1. Whole texts count, however
    long; repeated rows are judged alike; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(c).alias(f"carry_{c}") for c in carry], F.col(text).cast("string").alias("text_"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    schema = StructType(rows.schema.fields[:-1] + [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])
    told = to_arrow_schema(schema)

    def run(batches):
        m = held.value
        for batch in batches:
            column = batch.column("text_")
            data, offsets = K.text_bytes(column)
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best, score = np.zeros(len(letters), np.int64), np.zeros(len(letters))
            for a, b in K.passes(offsets, 1 << 18):
                for low in range(a, b, 256):
                    high = min(b, low + 256)
                    if m.languages:
                        best[low:high], score[low:high] = m.predict(counts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
            known = letters & bool(m.languages)
            names = [m.languages[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]
            score = np.where(known, np.clip(score, 0, 1), 0.0)
            far = ~known | (score < (m.floor[best] if m.languages else 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).cast(told.field(i).type) for i in range(len(told) - 3)), pa.array(names, pa.string()), pa.array(score), pa.array(far)], schema=told)

    return rows.mapInArrow(run, schema).select(*[F.col(f"carry_{c}").alias(c) for c in carry], "lang_pred", "score", "rejected")
