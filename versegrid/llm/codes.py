"""Vector code compression: codebooks of integers for equal parts of a vector.

Components become integers, so that every task order gives the same books. In
each round the books are broadcast, Arrow batches compute all distances by the
expansion of the norm with exact int64 products, the first least entry takes
the part, and the entries' sums are merged by a grouped shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard
from .integers import first_vectors, matrix, moved, quantised, summed_by, totals, with_group_sum

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


def nearest(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts, entry of each part, its squared distance): parts x rows, ties to the lower entry."""
    parts, _, width = books.shape
    x = v.reshape(len(v), parts, width).transpose(1, 0, 2)
    far = (books * books).sum(2)[:, None, :] - 2 * (x @ books.transpose(0, 2, 1))
    entry = far.argmin(2)
    return x, entry, np.take_along_axis(far, entry[..., None], 2)[..., 0] + (x * x).sum(2)


def train(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) from :func:`integers.quantised` rows; fewer entries where there are fewer rows."""
    start = first_vectors(rows, [F.col("id").asc_nulls_last()], entries)
    if not len(start) or not start.shape[1] or start.shape[1] % parts:
        return np.zeros((parts, 0, 0), np.int64)
    entries, width = len(start), start.shape[1] // parts
    books = start.reshape(entries, parts, width).transpose(1, 0, 2).copy()
    shape, size = (parts, entries, width + 1), parts * entries * (width + 1)
    for _ in range(rounds):

        def task(batches, books=books):
            out = np.zeros(shape, np.int64)
            for batch in batches:
                if len(batch):
                    x, entry, _ = nearest(matrix(batch.column("v")), books)
                    for p in range(parts):
                        sums, counts = summed_by(entry[p], x[p], entries)
                        out[p, :, :-1] += sums
                        out[p, :, -1] += counts
            return out.reshape(-1)

        told = totals(rows.select("v"), task, size).reshape(shape)
        books = moved(books, told[..., :-1], told[..., -1])
    return books


def digest_of(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encoded(rows: DataFrame, books: np.ndarray, carry: tuple[str, ...]) -> DataFrame:
    """id, the carried columns, code (entries as two hex digits a part) and error of each row."""
    kept = [f for f in rows.schema.fields if f.name in ("id", *(f"carry_{c}" for c in carry))]
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            n = len(batch)
            _, entry, far = nearest(matrix(batch.column("v")), books) if n else (None, np.zeros((len(books), 0), int), np.zeros((1, 0), np.int64))
            codes = [row.tobytes().hex() for row in np.ascontiguousarray(entry.T.astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(codes, pa.string()), pa.array(far.sum(0), pa.int64())], [*names, "code", "error"])

    return rows.select(*names, "v").mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", code string, error bigint")


def compress(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", dimensions: int | None = None, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row, under the names of ``key`` and so on.

    Rows whose vector is null or holds null or non-finite components go.
    ``dimensions`` is the vectors' length; None takes that of the kept row with
    the least key, and rows of another length go too. Where the parts don't
    divide it, no row has a code and the result is empty. Repeated rows are
    vectors of their own with rows of their own; among rows of one key the
    lesser vector comes first; null keys come last; null labels are one label;
    fewer rows than entries give as many entries; other columns are ignored; an
    empty table gives an empty result. Components beyond 32,768 raise an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry has two hex digits")
    rows, path = quantised(vectors, scale, key=key, vector=vector, carry=(label,))
    if dimensions is None:
        first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("n")).collect()
        dimensions = first[0]["n"] if first else 0
    rows = rows.where(F.size("v") == dimensions)
    books = train(rows, parts=parts, entries=entries, rounds=rounds)
    done = cut(encoded(rows if books.size else rows.limit(0), books, (label,)))
    discard(vectors.sparkSession, path)
    out = with_group_sum(done, f"carry_{label}", "error", "label_error")
    return out.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256"))


def _rounds_sql() -> str:
    """Assignments and books of all rounds, as one chain of tables."""
    out = []
    for k in range(ROUNDS + 1):
        out.append(f"""a{k} AS MATERIALIZED (SELECT r, part, entry, far FROM (SELECT x.r, x.part, b.entry, sum((x.x - b.c) * (x.x - b.c)) AS far FROM cells x JOIN b{k} b USING (part, pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY far, entry) = 1)""")
        if k < ROUNDS:
            out.append(f"""b{k + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), c) AS c FROM b{k}
  LEFT JOIN (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM cells JOIN a{k} USING (r, part) GROUP BY ALL) USING (part, entry, pos))""")
    return ",\n".join(out)


COMPRESS_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT r, part, pos, v[part * w + pos + 1] AS x FROM (SELECT *, len(v) // {PARTS} AS w FROM kept), range({PARTS}) AS p(part), range(w) AS q(pos)
), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x AS c FROM cells WHERE r <= {ENTRIES}),
{_rounds_sql()},
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS}),
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), books
"""
