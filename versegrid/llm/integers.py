"""Vectors as exact integers, sums by cell, and sums of groups attached to their rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Largest integer component; squared distances of 64 dimensions then fit 64 bits.
LARGEST = 1 << 27
#: Groups up to which their sums are broadcast, and salts that split a group's rows beyond that.
FEW_GROUPS, SALTS = 10_000, 64


def finite(vector: Column) -> Column:
    """The vector is there and no component is null, NaN or infinite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & fine


def quantised(vectors: DataFrame, scale: int, *, key: str, vector: str, carry: tuple[str, ...] = (), dimensions: int | None = None) -> tuple[DataFrame, str]:
    """id, the carried columns as ``carry_...`` and v: floor(scale * x) of each component x, written to the shared folder and reread; and where.

    Rows whose vector isn't :func:`finite` go, and where ``dimensions`` is given
    those of another length. A component beyond LARGEST raises an error, as
    distances would leave 64 bits.
    """
    x = F.col(vector)
    kept = vectors.where(finite(x))
    if dimensions is not None:
        kept = kept.where(F.size(x) == dimensions)

    def whole(c: Column) -> Column:
        y = F.floor(c.cast("double") * scale)
        return F.when(F.abs(y) <= LARGEST, y.cast("int")).otherwise(F.raise_error(F.lit(f"a component of {vector} is beyond the exact range")).cast("int"))

    narrow = kept.select(F.col(key).alias("id"), *[F.col(c).alias(f"carry_{c}") for c in carry], F.transform(x, whole).alias("v"))
    path = scratch(vectors.sparkSession, "integers")
    narrow.write.option("compression", "zstd").parquet(path)
    return vectors.sparkSession.read.parquet(path), path


def first_vectors(rows: DataFrame, order: list[Column], count: int) -> np.ndarray:
    """The vectors of the first ``count`` rows in an order, which their values complete; a fixed number, whatever the rows."""
    return np.array([r.v for r in rows.orderBy(*order, "v").limit(count).select("v").collect()], np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as rows of int64."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def summed_by(cell: np.ndarray, values: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the rows of each cell, in whole numbers."""
    counts = np.bincount(cell, minlength=cells).astype(np.int64)
    sums = np.zeros((cells, values.shape[1]), np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        firsts = (np.cumsum(counts) - counts)[some]
        sums[some] = np.add.reduceat(values[np.argsort(cell, kind="stable")], firsts, axis=0)
    return sums, counts


def totals(rows: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], np.ndarray], slots: int) -> np.ndarray:
    """The sum over all tasks of the ``slots`` numbers that ``task`` makes of its batches, exactly.

    Each task emits its numbers once; a grouped shuffle merges them, so the
    driver gets ``slots`` numbers however many tasks there are.
    """

    def run(batches):
        told = task(batches)
        at = np.flatnonzero(told)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(told[at])], ["slot", "n"])

    parts = rows.mapInArrow(run, "slot int, n bigint")
    out = np.zeros(slots, object)
    for r in parts.groupBy("slot").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
        out[r.slot] = int(r.n)
    return out


def moved(centres: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Centres replaced by floor(sum / count) of what they were given; those without any stay. Sums may be beyond 64 bits."""
    means = sums // np.maximum(counts, 1)[..., None]
    return np.where(counts[..., None] > 0, means, centres).astype(np.int64)


def with_group_sum(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over their group, nulls together.

    Sums are pre-aggregated by task. Few groups are broadcast after they have
    been counted; otherwise both sides are dealt by group and salt, so that no
    task gets a whole group.
    """
    sums = rows.groupBy(F.col(group).alias("g_")).agg(F.sum(F.col(value).cast("decimal(38,0)")).cast("bigint").alias(name))
    if sums.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        return rows.join(F.broadcast(sums), F.col(group).eqNullSafe(F.col("g_"))).drop("g_")
    salted = sums.withColumn("s_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("t_", F.pmod(F.xxhash64(value, "id"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col(group).eqNullSafe(F.col("g_")) & (F.col("t_") == F.col("s_"))).drop("g_", "s_", "t_")
