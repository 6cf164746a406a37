"""Embedding near-dedup with randomised-rotation binary codes.

Vectors are normalised and rotated at random; the signs are a vector's code,
stored with its correction factor <code, vector>. From a code, its factor and
another vector in full, the inner product has an unbiased estimate with a
confidence bound. A vector travels as its code, factor and rotated form in
eight bits; bounds over these tell which vectors of a bucket have a pair that
may reach the threshold, and only these are fetched in full to have such pairs
recomputed in double precision. Buckets over the signs of random planes, in as
many tables as the wanted recall takes, bring the pairs together. Each table
has planes of its own, so its misses are independent of the others'.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .graph import components
from .neardup import Forest

THRESHOLD = 0.95
#: Chance to miss a pair right at the threshold in all tables.
MISS = 2e-3
#: Vectors that a bucket holds on average, if nothing is close to anything.
BUCKET = 64
#: Rows of a block in a large bucket's comparison.
BLOCK = 1024
#: Standard errors of the estimate's upper bound.
SIGMAS = 4.0


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(d + 11).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def plan(rows: int, dimensions: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits of a bucket, tables) for so many vectors."""
    bits = min(dimensions, 60, max(4, math.ceil(math.log2(max(2, rows) / BUCKET))))
    same = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log(1 - same**bits))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated, signs, factors) of unit vectors."""
    y = x @ rotation(x.shape[1])
    code = np.where(y >= 0, 1.0, -1.0)
    return y, code, np.abs(y).sum(axis=1) / math.sqrt(x.shape[1])


def upper_bounds(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, sigmas: float = SIGMAS) -> np.ndarray:
    """Upper confidence bounds of <x, q> for coded x (rows) and full rotated q (columns)."""
    d = codes.shape[1]
    f = np.maximum(factors, 1e-9)[:, None]
    estimate = (codes @ queries.T) / math.sqrt(d) / f
    error = np.sqrt(np.maximum(0, 1 - f * f)) / f / math.sqrt(max(1, d - 1))
    return estimate + sigmas * error


def pack(y: np.ndarray, code: np.ndarray, factors: np.ndarray) -> list[bytes]:
    """Of each vector: factor and step (float32), the code's bits, and the rotated vector in whole steps of one byte."""
    step = np.maximum(np.abs(y).max(axis=1), 1e-30) / 127
    head = np.stack((factors, step), axis=1).astype("<f4").view(np.uint8)
    rows = np.concatenate((head, np.packbits(code > 0, axis=1), np.rint(y / step[:, None]).astype(np.int8).view(np.uint8)), axis=1)
    return [r.tobytes() for r in np.ascontiguousarray(rows)]


def unpack(blobs: list[bytes], d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, factors, rotated vectors within half a step, steps)."""
    raw = np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)
    head = np.ascontiguousarray(raw[:, :8]).view("<f4")
    bits = -(-d // 8)
    code = np.unpackbits(raw[:, 8 : 8 + bits], axis=1)[:, :d].astype(np.float32) * 2 - 1
    steps = head[:, 1]
    return code, head[:, 0], raw[:, 8 + bits :].view(np.int8).astype(np.float32) * steps[:, None], steps


def may_reach(left, right, threshold: float) -> np.ndarray:
    """Which pairs of packed vectors an upper bound of either direction leaves open; rounding to steps is bounded too."""
    def bounds(coded, full):
        code, factor = coded[0], coded[1]
        d = code.shape[1]
        rounding = math.sqrt(d) / 2 * full[3][None, :] / np.maximum(factor, 1e-9)[:, None]
        return upper_bounds(code, factor, full[2]) + rounding

    slack = 1e-4  # of the packed numbers' precision
    return np.minimum(bounds(left, right), bounds(right, left).T) >= threshold - slack


def _matrix(column: pa.Array) -> list[np.ndarray]:
    return [np.array(v, np.float64) for v in column.to_pylist()]


def _buckets(threshold: float, miss: float, total: int):
    """For each vector, its packed code and its bucket in each table."""

    def run(batches):
        for batch in batches:
            vecs = _matrix(batch.column(1))
            dims = np.array([len(v) for v in vecs])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.array([vecs[i] for i in at])
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = bucket_keys(x, *plan(total, int(d), threshold, miss))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)).cast(pa.int64()), pa.array(np.full(len(at), d, np.int32)), pa.array(pack(*encode(x)), pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))], names=["v", "d", "c", "keys"])

    return run


def _screen(threshold: float):
    """Of each block pair's vectors, those that the bounds leave a pair; rows arrive sorted by task."""

    def judge(rows):
        d, i, j = rows[0][3], rows[0][5], rows[0][6]
        packed = unpack([r[7] for r in rows], d)
        block = np.array([r[4] for r in rows])
        left = np.arange(len(rows)) if i == j else np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block != i)
        open_ = np.zeros(len(rows), bool)
        others = tuple(a[right] for a in packed)
        for low in range(0, len(left), 512):
            part = left[low : low + 512]
            maybe = may_reach(tuple(a[part] for a in packed), others, threshold)
            if i == j:
                maybe[np.arange(len(part)), np.arange(low, low + len(part))] = False
            open_[part] |= maybe.any(axis=1)
            open_[right] |= maybe.any(axis=0)
        return [rows[n][:7] for n in np.flatnonzero(open_)]

    def told(rows):
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n in ("task", "v") else pa.int32()) for c, n in zip(columns, _TASK, strict=True)], names=_TASK)

    def run(batches):
        now, rows = None, []
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != now:
                    out.extend(judge(rows) if len(rows) > 1 else ())
                    now, rows = r[0], []
                rows.append(r)
            yield told(out)
        yield told(judge(rows) if len(rows) > 1 else [])

    return run


#: Columns of a vector's part in a block pair's comparison.
_TASK = ["task", "t", "v", "d", "mine", "i", "j"]


@lru_cache(4)
def planes(d: int, bits: int, tables: int) -> np.ndarray:
    """d x tables x bits: the normals of each table's planes."""
    return np.random.default_rng(d * 1000 + bits).standard_normal((tables, bits, d)).transpose(2, 0, 1).copy()


def bucket_keys(unit: np.ndarray, bits: int, tables: int, upto: int | None = None) -> np.ndarray:
    """Each vector's bucket in each table, or in the first ``upto`` ones."""
    normals = planes(unit.shape[1], bits, tables)[:, :upto]
    out = np.empty((len(unit), normals.shape[1]), np.int64)
    for t in range(normals.shape[1]):
        out[:, t] = (unit @ normals[:, t] >= 0) @ (1 << np.arange(bits, dtype=np.int64))
    return out


def _compare(threshold: float, miss: float, total: int):
    """Exact links of a bucket's block pair; a pair is counted in the first table that brings it together."""
    none = [np.zeros(0, np.int64)] * 3

    def judge(rows):
        same_block, table = rows[0][4] == rows[0][5], rows[0][1]
        ids, own = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        weight, block = np.array([r[6] for r in rows]), own
        x = np.array([r[7] for r in rows], np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        rotated, code, factor = encode(unit)
        bits, tables = plan(total, x.shape[1], threshold, miss)
        earlier = bucket_keys(unit, bits, tables, table)
        left = np.arange(len(ids)) if same_block else np.flatnonzero(block == rows[0][4])
        right = left if same_block else np.flatnonzero(block != rows[0][4])
        a_out, b_out = [], []
        for low in range(0, len(left), 512):
            part = left[low : low + 512]
            maybe = upper_bounds(code[part], factor[part], rotated[right]) >= threshold
            i, j = np.nonzero(maybe)
            i, j = part[i], right[j]
            if same_block:
                i, j = i[i < j], j[i < j]
            exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[exact], j[exact]
            fresh = np.ones(len(i), bool)
            for t in range(table):
                fresh &= earlier[i, t] != earlier[j, t]
            a_out.append(i[fresh])
            b_out.append(j[fresh])
        i, j = np.concatenate(a_out) if a_out else none[0], np.concatenate(b_out) if b_out else none[0]
        gained = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        forest = Forest(len(ids))
        links = [(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if forest.join(a, b)]
        return [(int(ids[n]), None, int(gained[n])) for n in np.flatnonzero(gained)] + [(int(ids[a]), int(ids[b]), 0) for a, b in links]

    def run(batches):
        now, rows = None, []
        for batch in batches:
            out = []
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != now:
                    out.extend(judge(rows) if len(rows) > 1 else ())
                    now, rows = r[0], []
                rows.append(r)
            yield _links(out)
        yield _links(judge(rows) if len(rows) > 1 else [])

    return run


def _links(rows):
    a, b, n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])


def link(vecs: DataFrame, *, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row for each row: vec_id, n_links, component_id, kept.

    Links are pairs of rows with cosine at the threshold or above, in double
    precision; equal vectors form a class that is joined once. Vectors that
    are null, zero or hold null or non-finite components link with nothing,
    nor do vectors of different lengths with each other. A row with a null id
    takes no part and has component_id null. Repeated rows link with each
    other. Other columns are ignored.
    """
    src = vecs.select(F.col(key).cast("bigint").alias("vec_id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("x"))
    fine = F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & F.coalesce(F.exists("x", lambda v: v != 0), F.lit(False))
    live = src.where(fine)
    classes = cut(live.groupBy("x").agg(F.min("vec_id").alias("v"), F.count("*").alias("w")))
    total = classes.count()
    spread = cut(classes.select("v", "x").mapInArrow(_buckets(threshold, miss, total), "v bigint, d int, c binary, keys array<bigint>"))
    placed = spread.select("v", "d", "c", F.posexplode("keys").alias("t", "k"))
    sizes = placed.groupBy("d", "t", "k").agg(F.count("*").alias("n")).where("n > 1")
    there = placed.join(sizes, ["d", "t", "k"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("mine", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    tasks = there.select("v", "d", "c", "t", "k", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    tasks = tasks.select(F.xxhash64("d", "t", "k", "i", "j").alias("task"), "t", "v", "d", "mine", "i", "j", "c").repartition("task").sortWithinPartitions("task")
    opened = tasks.mapInArrow(_screen(threshold), "task bigint, t int, v bigint, d int, mine int, i int, j int")
    work = opened.join(classes, "v").select("task", "t", "v", "mine", "i", "j", "w", "x")
    found = cut(work.repartition("task").sortWithinPartitions("task").mapInArrow(_compare(threshold, miss, total), "a bigint, b bigint, n bigint"))
    gained = found.where("b is null").groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("gained"))
    joined = components(found.where("b is not null"))
    told = classes.join(gained, "v", "left").join(joined, "v", "left").select("x", (F.coalesce("gained", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("label", "v").alias("component_id"))
    alone = src.where(~fine).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = live.join(told, "x").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


LINK_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), fine AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id, vec_id AS c FROM v UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.vec_id
), least AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""
