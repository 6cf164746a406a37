"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import once
from ..functions.storage import cut, shared_dir  # noqa: F401 - cut is for the operators
from . import kernels as K


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for a table that is written and reread."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`scratch` named."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Bits of a :func:`bitmap` at most (16 MB); a fuller one lets more pass and loses none.
MOST_BITS = 27


def bitmap(df: DataFrame, hashes, count: int) -> tuple[np.ndarray, int]:
    """(64-bit words, bits) of a bitmap of all hashes that ``hashes`` takes from a batch of ``df``, for about ``count`` of them.

    Its size is bounded whatever ``df`` holds: masks are merged on the
    executors, and the driver gets the bitmap alone.
    """
    bits = min(max(int(count).bit_length() + 4, 16), MOST_BITS)

    def masks(bits, batches):
        for batch in batches:
            at, mask = K.bit_masks(hashes(batch), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(mask.view(np.int64))], names=["at", "mask"])

    told = df.mapInArrow(partial(masks, bits), "at bigint, mask bigint").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), K.U)
    out[told.column("at").to_numpy()] = told.column("mask").to_numpy().view(K.U)
    return out, bits


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(*values: Column) -> Column:
    """A shuffle key of 60 bits that DuckDB can compute too; nulls are empty."""
    told = F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("")) for v in values])
    return F.conv(F.substring(F.md5(told), 1, 15), 16, 10).cast("bigint")


#: Spans that are cut out in one go.
_BLOCK = 128


def _blocks(values: Column) -> Column:
    last = F.greatest(F.ceil(F.size(values) / _BLOCK).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))


def _upto(values: Column, start: Column) -> Column:
    zero = F.struct(start.alias("most"), F.slice(F.array(start), 1, 0).alias("out"))
    return F.aggregate(values, zero, lambda acc, x: F.struct(F.greatest(acc["most"], x).alias("most"), F.concat(acc["out"], F.array(F.greatest(acc["most"], x))).alias("out")))["out"]


def running_max(values: Column) -> Column:
    """The greatest of each value and those before it; by blocks, so that no long array is copied for each element."""

    def joined(all_: Column) -> Column:
        before = _upto(F.transform(all_, lambda b: F.coalesce(F.array_max(b), F.lit(0))), F.lit(0))
        return once(before, lambda most: F.flatten(F.transform(all_, lambda b, i: _upto(b, F.when(i > 0, most[i - 1]).otherwise(0)))))

    return once(_blocks(values), joined)


def merged(starts: Column, ends: Column) -> Column:
    """Maximal runs (start, end) of spans that are given in order of their starts; spans that touch stay apart."""

    def runs(most: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(starts) - 1), lambda i: (i == 0) | (starts[i] >= most[i - 1]))
        return once(firsts, lambda f: F.transform(f, lambda i, j: F.struct(starts[i].alias("start"), most[F.coalesce(F.get(f, j + 1), F.size(starts)) - 1].alias("end"))))

    none = F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), 1, 0)
    return F.when(F.size(starts) > 0, once(running_max(ends), runs)).otherwise(none)


def without(text: Column, runs: Column, mark: str = "") -> Column:
    """``text`` with the given runs (in order, apart) replaced by ``mark``.

    The text is cut into pieces of many runs, and each of these at its runs, so
    the cost grows with the text and not with the text times its runs.
    """

    def pieces(all_: Column) -> Column:
        def kept(block: Column, b: Column) -> Column:
            low = F.when(b > 0, F.element_at(all_[b - 1], -1)["end"]).otherwise(0)

            def cut_at(part: Column) -> Column:
                at = lambda i: F.when(i > 0, block[i - 1]["end"]).otherwise(low)
                return F.array_join(F.transform(block, lambda r, i: F.concat(F.substring(part, at(i) - low + 1, r["start"] - at(i)), F.lit(mark))), "")

            return once(F.substring(text, low + 1, F.element_at(block, -1)["end"] - low), cut_at)

        rest = F.substring(text, F.element_at(F.element_at(all_, -1), -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(F.transform(all_, kept), ""), rest)

    return F.when(F.size(runs) > 0, once(_blocks(runs), pieces)).otherwise(text)
