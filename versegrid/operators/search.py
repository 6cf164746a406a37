"""Substring search by posting lists of three-byte grams, verified against the texts.

The index holds, for each gram of the texts' UTF-8, lists of the keys whose
texts have it, and how many keys that are. A batch of terms joins it: a text
that holds a term holds all of the term's grams, so the least frequent of them
leave few candidates, and only these texts are read. Texts end in two bytes of
no text, so a gram starts at every byte, and a term of one or two bytes stands
in exactly those texts that have a gram which starts with it.

Lists are made batch by batch where the texts stand, a row a gram and block of
texts: a row for each gram of each text is never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.storage import cut

#: Grams that a term looks for at most; the others are left to the verification.
RAREST = 4
#: Texts of a block, whose keys are a gram's list at most, and bytes of texts that are taken at once.
BLOCK, BYTES = 4096, 4 << 20
#: Grams of terms up to which they are broadcast to the lists; more of them meet the lists in a shuffle.
BROADCAST_GRAMS = 500_000
_END = bytearray(b"\xff\xff")


def joined(*parts: Column) -> Column:
    """What is searched: the parts in lower case with a space between them; null is empty."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def _number(some: Column) -> Column:
    return F.conv(F.hex(some), 16, 10).cast("int")


def grams(text: Column) -> Column:
    """The distinct three-byte grams of a text of three bytes or more, as numbers."""
    raw = text.cast("binary")
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.octet_length(text) - 2), lambda i: _number(F.substring(raw, i, F.lit(3)))))


def _postings(block: int, most: int):
    """(gram, n, keys) of each block of texts; the texts come as bytes, with their two last ones."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            keys, raw = batch.column(0), batch.column(1).cast(pa.large_binary())
            offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
            a = 0
            while a < len(raw):
                b = max(a + 1, min(a + block, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1))
                ends, shift = offsets[a : b + 1], (b - a).bit_length()
                # A text beyond the bytes of a pass is taken in parts that overlap by two bytes.
                for low in range(int(ends[0]), int(ends[-1]) - 2, most):
                    d = data[low : min(low + most + 2, int(ends[-1]))].astype(np.int64)
                    gram = d[:-2] << 16 | d[1:-1] << 8 | d[2:]
                    owner = np.repeat(np.arange(b - a), np.diff(np.clip(ends, low, low + len(gram))))
                    inside = np.arange(low, low + len(gram)) < ends[1:][owner] - 2
                    pair = np.unique(gram[inside] << shift | owner[inside])
                    gram = pair >> shift
                    first = np.flatnonzero(np.diff(gram, prepend=-1))
                    n = np.diff(first, append=len(gram)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(gram)), pa.int32()), keys.take(pa.array(a + (pair & (1 << shift) - 1))))
                    yield pa.RecordBatch.from_arrays([pa.array(gram[first].astype(np.int32)), pa.array(n), lists], names=["gram", "n", "keys"])
                a = b

    return run


class TextIndex:
    """An index in a folder: ``postings`` (gram, n, keys), ``grams`` (gram, n) and ``texts`` (key, text)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def build(self, rows: DataFrame, key: str, *parts: Column) -> TextIndex:
        """Index the texts of ``rows``; rows of one key are searched apart and found as one. A null key is never found."""
        texts = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), joined(*parts).alias("text"))
        texts.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/texts")
        stored = self._read("texts")
        ended = stored.select("key", F.concat(F.col("text").cast("binary"), F.lit(_END)).alias("raw"))
        listed = ended.mapInArrow(_postings(BLOCK, BYTES), f"gram int, n int, keys array<{stored.schema['key'].dataType.simpleString()}>")
        listed.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/postings")
        counted = self._read("postings").groupBy("gram").agg(F.sum("n").alias("n"))
        counted.write.mode("overwrite").parquet(f"{self.folder}/grams")
        return self

    def search(self, terms: DataFrame, term: str = "term") -> DataFrame:
        """(term, key) of every text that holds a term, in any case: a row a pair. Null terms find nothing, an empty one every text."""
        asked = terms.select(F.col(term).alias("term")).where("term is not null").distinct().withColumn("low", F.lower("term"))
        size = F.octet_length("low")
        return self._long(asked.where(size >= 3)).unionByName(self._short(asked.where(size.between(1, 2)))).unionByName(self._every(asked.where(size == 0)))

    def _met(self, wanted: DataFrame) -> DataFrame:
        """The lists of the grams of ``wanted``, beside its columns; lists are shuffled only for very many grams."""
        wanted = cut(wanted)
        return self._read("postings").drop("n").join(F.broadcast(wanted) if wanted.count() <= BROADCAST_GRAMS else wanted, "gram")

    def _long(self, asked: DataFrame) -> DataFrame:
        wanted = asked.select("term", "low", F.size(grams(F.col("low"))).alias("needed"), F.explode(grams(F.col("low"))).alias("gram"))
        # A term with a gram that no text has is gone here.
        known = wanted.join(self._read("grams"), "gram").withColumn("known", F.count("*").over(Window.partitionBy("term"))).where("known = needed")
        rarest = known.withColumn("r", F.row_number().over(Window.partitionBy("term").orderBy("n", "gram"))).where(F.col("r") <= RAREST)
        all_ = F.call_function("shiftleft", F.lit(1), F.least(F.col("needed"), F.lit(RAREST))) - 1
        rarest = rarest.select("gram", "term", "low", all_.alias("all_"), F.call_function("shiftleft", F.lit(1), F.col("r") - 1).alias("bit"))
        hits = self._met(rarest).select("term", "low", "all_", "bit", F.explode("keys").alias("key"))
        # A key may come more than once with one gram, by texts that share it or by parts of a long one.
        candidates = hits.groupBy("term", "low", "all_", "key").agg(F.bit_or("bit").alias("found")).where("found = all_").select("term", "low", "key")
        return candidates.join(self._read("texts"), "key").where(F.contains("text", F.col("low"))).select("term", "key").distinct()

    def _short(self, asked: DataFrame) -> DataFrame:
        """By the grams that start with the term; these are told from the list of grams, at most 2^24."""
        first = _number(F.col("low").cast("binary"))
        coded = asked.select("term", first.alias("first"), F.octet_length("low").alias("size"))
        starts = lambda n: self._read("grams").select("gram", F.shiftright("gram", 24 - 8 * n).alias("first"), F.lit(n).alias("size"))
        found = self._met(coded.join(starts(1).unionByName(starts(2)), ["first", "size"]).select("gram", "term"))
        return found.select("term", F.explode("keys").alias("key")).distinct()

    def _every(self, asked: DataFrame) -> DataFrame:
        # One term at most: the empty one.
        return asked.select("term").crossJoin(self._read("texts").select("key").distinct())
