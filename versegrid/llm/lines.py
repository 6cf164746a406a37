"""Reversible line dedup: sharded cuckoo filters over an exact table of references.

A line's key is its text without ASCII white space at both ends, A-Z lowered.
Each (key, document) is a reference, stored with a count, so that documents can
come and go. Keys are dealt to shards by their hash; a shard's cuckoo filter
holds the fingerprint of a live key once, and twice if two documents or more
hold it. So the filter tells without a read of the table that a new line is
unknown, or that a line is in one document alone; only what may be known or
repeated meets the exact table. A key that loses documents loses fingerprints.

An index is a folder of versions: ``references`` (what each change added or
took away), ``counts`` (keys that had or have two documents, as the change left
them), ``filters`` (the shards it touched) and, written last, ``commits``; a
version without its commit is no version and is written again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from . import kernels as K
from .common import discard, scratch, sha256_hex

#: Code points of a key that counts.
LEAST = 10
#: Buckets of a filter's part (as bits), fingerprints of a bucket, and the shares of a part that are planned to be filled and that are filled at most.
BUCKET_BITS, SLOTS, LOAD, FULL = 14, 4, 0.8, 0.93
#: Rounds of kicks until a part counts as full.
KICKS = 64
#: Tasks among which the references that meet one shard are split.
SALTS = 8
_SPACE = b" \t\n\x0b\x0c\r"
#: What stands for a null id: behind all others.
_LAST = (1 << 63) - 1


class Cuckoo:
    """Cuckoo filter of 16-bit fingerprints that may hold one several times; parts of one size are added where one is full.

    All parts share their geometry: two keys of one fingerprint and bucket are
    alike in every part, so that taking one of them away never loses the other.
    """

    def __init__(self, bits: int = BUCKET_BITS, parts: list[np.ndarray] | None = None):
        self.mask = np.int64((1 << bits) - 1)
        self.parts = parts if parts is not None else []

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first bucket) of 64-bit hashes; 0 is an empty slot and no fingerprint."""
        u = h.astype(np.int64).view(K.U)
        mark = (u >> K.U(48)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, (u & K.U(self.mask)).astype(np.int64)

    def other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The second bucket from the first one, and back; never the same."""
        return at ^ ((K.mix64(mark.astype(K.U)) & K.U(self.mask)).astype(np.int64) | 1)

    def count(self, h: np.ndarray) -> np.ndarray:
        """How many fingerprints of each key there are: at least as many as were put in."""
        mark, at = self.places(h)
        out, to = np.zeros(len(h), np.int64), self.other(mark, at)
        for part in self.parts:
            out += (part[at] == mark[:, None]).sum(1) + (part[to] == mark[:, None]).sum(1)
        return out

    def add(self, h: np.ndarray) -> None:
        mark, at = self.places(h)
        for part in self.parts:
            mark, at = self._fill(part, mark, at)
        while len(mark):
            self.parts.append(np.zeros((int(self.mask) + 1, SLOTS), np.uint16))
            mark, at = self._fill(self.parts[-1], mark, at)

    def _fill(self, part: np.ndarray, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put in what the part takes; what is left, which may be others than were given."""
        room = max(0, int(FULL * part.size) - int((part != 0).sum()))
        mark, at, more = mark[:room], at[:room], (mark[room:], at[room:])
        for kick in range(2 * KICKS):
            if not len(mark):
                break
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            first = np.r_[True, at[1:] != at[:-1]]
            rank = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            empty = part[at] == 0
            # The rank-th empty slot of the bucket takes the rank-th that wants in.
            fits = rank < empty.sum(1)
            slot = (np.cumsum(empty, 1) == rank[:, None] + 1).argmax(1)
            part[at[fits], slot[fits]] = mark[fits]
            mark, at, first = mark[~fits], at[~fits], np.r_[True, at[~fits][1:] != at[~fits][:-1]] if (~fits).any() else first[:0]
            if kick % 2:
                # One a bucket changes places with a fingerprint there, which wants into its other bucket.
                f = np.flatnonzero(first)
                s = (kick // 2 + at[f]) % SLOTS
                mark[f], part[at[f], s] = part[at[f], s], mark[f].copy()
            at = self.other(mark, at)
        return np.concatenate((mark, more[0])), np.concatenate((at, more[1]))

    def take(self, h: np.ndarray) -> None:
        """Take one fingerprint of each key away; each must have been put in."""
        mark, at = self.places(h)
        for part in self.parts:
            for _ in range(2):
                left = np.arange(len(mark))
                gone = np.zeros(len(mark), bool)
                while len(left):
                    same = part[at[left]] == mark[left][:, None]
                    left, slot = left[same.any(1)], same.argmax(1)[same.any(1)]
                    # Equal ones take one slot each, one at a time.
                    _, once = np.unique(at[left] * SLOTS + slot, return_index=True)
                    part[at[left[once]], slot[once]] = 0
                    gone[left[once]] = True
                    left = np.setdiff1d(left, left[once])
                mark, at = mark[~gone], self.other(mark[~gone], at[~gone])
        if len(mark):
            raise ValueError("a fingerprint that was never put in")

    def rows(self) -> list[bytes]:
        return [p.tobytes() for p in self.parts]

    @classmethod
    def of(cls, blobs: list[bytes], bits: int) -> Cuckoo:
        return cls(bits, [np.frombuffer(b, np.uint16).reshape(-1, SLOTS).copy() for b in blobs])


def _key(line: bytes) -> int | None:
    """The line's key as 128 bits; None where it is too short to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.decode()) < LEAST):
        return None
    return xxh3_128_intdigest(key)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, K.U).view(np.int64)


def _identified(docs: DataFrame, key: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc, row (a hash that tells versions of a document apart), body and the carried columns."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST)).alias("doc"), F.xxhash64(body).alias("row"), body.alias("body"), *[F.col(c).alias(f"carry_{c}") for c in carry])


def references(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """k1, k2, doc, row: one row for each distinct key of a text that counts."""

    def run(batches):
        for batch in batches:
            high, low, at = [], [], []
            for i, body in enumerate(batch.column("body").cast(pa.binary()).to_pylist()):
                found = {k for line in body.split(b"\n") if (k := _key(line)) is not None}
                high.extend(k >> 64 for k in found)
                low.extend(k & 0xFFFFFFFFFFFFFFFF for k in found)
                at.extend([i] * len(found))
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(_signed(high)), pa.array(_signed(low)), batch.column("doc").take(where), batch.column("row").take(where)], ["k1", "k2", "doc", "row"])

    return _identified(docs, key, text).mapInArrow(run, "k1 bigint, k2 bigint, doc bigint, row bigint")


_FILTER, _TABLE, _ASKED = 0, 1, 2
_MET = "shard int, salt int, kind int, k1 bigint, k2 bigint, doc bigint, row bigint, n bigint, blob binary"


def _as_met(rows: DataFrame, kind: int, **columns: Column) -> DataFrame:
    """Rows in the form in which they meet in a shard."""
    told = columns | {"kind": F.lit(kind)}
    out = []
    for name, type_ in (f.split(" ") for f in _MET.split(", ")):
        out.append(told.get(name, F.col(name) if name in rows.columns else F.lit(0 if name == "salt" else None)).cast(type_).alias(name))
    return rows.select(*out)


def _runs(batches):
    """((shard, salt), kind, slice) of each run of rows of one shard, salt and kind."""
    for batch in batches:
        if not len(batch):
            continue
        told = [batch.column(c).to_numpy() for c in ("shard", "salt", "kind")]
        cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in told], axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(batch)], strict=True):
            yield (int(told[0][a]), int(told[1][a])), int(told[2][a]), batch.slice(a, b - a)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]


def _met(*sides: DataFrame) -> DataFrame:
    """All sides by shard and salt, filters first and what is asked last."""
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    return rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")


class Index:
    """The line index in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, *, bits: int = BUCKET_BITS, salts: int = SALTS):
        self.spark, self.folder, self.bits, self.salts = spark, folder.rstrip("/"), bits, salts

    # The versions -----------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/version=*/_SUCCESS")
        found = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or ())

    def _path(self, table: str, version: int) -> str:
        return f"{self.folder}/{table}/version={version}"

    def _read(self, table: str, versions: list[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.folder}/{table}").parquet(*[self._path(table, v) for v in versions])

    def _latest(self, table: str, by: list[str]) -> DataFrame:
        """The rows that the last version with their key wrote."""
        versions = self.versions()
        rows = self._read(table, versions)
        if len(versions) == 1:
            return rows.drop("version")
        last = rows.groupBy(*by).agg(F.max("version").alias("version"))
        return rows.join(last, [*by, "version"], "left_semi").drop("version")

    def shards(self) -> int:
        return self.spark.read.parquet(self._path("commits", self.versions()[0])).first()["shards"]

    def filters(self) -> DataFrame:
        """shard, blob: the parts of each shard's filter."""
        return self._latest("filters", ["shard"]).select("shard", "blob")

    def counts(self) -> DataFrame:
        """k1, k2, refs (rows that hold the key), owner and last (least and greatest document) of keys in two documents or more."""
        return self._latest("counts", ["k1", "k2"]).where("owner < last")

    def live(self) -> DataFrame:
        """k1, k2, doc, row, n of the references that stand."""
        return self._read("references", self.versions()).groupBy("k1", "k2", "doc", "row").agg(F.sum("n").alias("n")).where("n > 0")

    # Changes ----------------------------------------------------------------------------------------------------

    def insert(self, docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Add the references of documents; they are returned as they were stored."""
        return self._change(references(docs, key=key, text=text).withColumn("n", F.lit(1).cast("bigint")), known=False)

    def delete(self, ids: DataFrame, *, key: str = "doc_id") -> DataFrame:
        """Take away all references of the documents of some ids; unknown ids change nothing."""
        if not self.versions():
            return self.spark.createDataFrame([], "k1 bigint, k2 bigint, doc bigint, row bigint, n bigint")
        gone = ids.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST)).alias("doc")).distinct()
        return self._change(self.live().join(gone, "doc", "left_semi").withColumn("n", -F.col("n")), known=True)

    def _change(self, delta: DataFrame, known: bool) -> DataFrame:
        before = self.versions()
        version = before[-1] + 1 if before else 1
        delta.select("k1", "k2", "doc", "row", "n").write.mode("overwrite").parquet(self._path("references", version))
        new = self._read("references", [version]).drop("version")
        path = scratch(self.spark, "line-keys")
        self._after(new, before, known).write.parquet(path)
        keys = self.spark.read.parquet(path)
        if before:
            shards = self.shards()
        else:
            wanted = keys.agg(F.sum(F.least(F.lit(2), "now")).alias("n")).first()["n"] or 1
            shards = 1 << max(0, int(np.ceil(np.log2(wanted / (LOAD * SLOTS * (1 << self.bits))))))
        keys.where("was = 2 or now = 2").select("k1", "k2", "refs", "owner", "last").write.mode("overwrite").parquet(self._path("counts", version))
        self._refiltered(keys.where("was <> now"), before, shards).write.mode("overwrite").parquet(self._path("filters", version))
        self.spark.createDataFrame([(shards,)], "shards int").coalesce(1).write.mode("overwrite").parquet(self._path("commits", version))
        discard(self.spark, path)
        return new

    def _after(self, delta: DataFrame, before: list[int], known: bool) -> DataFrame:
        """k1, k2, was and now (documents, 2 at most), refs, owner, last of each key of a change."""
        ends = [F.sum("n").alias("refs"), F.min("doc").alias("owner"), F.max("doc").alias("last")]
        now = F.when(F.col("refs") <= 0, 0).when(F.col("owner") < F.col("last"), 2).otherwise(1).alias("now")
        # Hot keys meet as one row a task.
        fresh = delta.groupBy("k1", "k2").agg(*ends).select("k1", "k2", F.lit(0).alias("was"), now, "refs", "owner", "last")
        if not before:
            return fresh
        maybe = fresh.select("k1", "k2") if known else self.known(fresh.select("k1", "k2"))
        salts = F.sequence(F.lit(0), F.lit(self.salts - 1))
        asked = maybe.withColumn("salt", F.explode(salts))
        # The exact table, for these keys alone; hot keys are split by document.
        old = self._read("references", before).drop("version").withColumn("old", F.col("n")).unionByName(delta.withColumn("old", F.lit(0).cast("bigint")))
        held = old.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(self.salts)).cast("int")).join(asked, ["k1", "k2", "salt"], "left_semi")
        by_doc = held.groupBy("k1", "k2", "doc").agg(F.sum("n").alias("n"), F.sum("old").alias("old"))
        alive, was = F.when(F.col("n") > 0, F.col("doc")), F.when(F.col("old") > 0, F.col("doc"))
        told = by_doc.groupBy("k1", "k2").agg(F.sum("n").alias("refs"), F.min(alive).alias("owner"), F.max(alive).alias("last"), F.min(was).alias("a"), F.max(was).alias("b"))
        had = F.when(F.col("a").isNull(), 0).when(F.col("a") < F.col("b"), 2).otherwise(1).alias("was")
        told = told.select("k1", "k2", had, now, "refs", "owner", "last")
        return told if known else told.unionByName(fresh.join(maybe, ["k1", "k2"], "left_anti"))

    def _sharded(self, rows: DataFrame, shards: int) -> DataFrame:
        return rows.withColumn("shard", F.pmod("k1", F.lit(shards)).cast("int"))

    def _refiltered(self, keys: DataFrame, before: list[int], shards: int) -> DataFrame:
        """shard, blob of the shards that hold keys whose ``was`` and ``now`` differ."""
        keys = self._sharded(keys, shards)
        sides = [_as_met(keys, _ASKED, n=F.col("now") - F.col("was"))]
        if before:
            sides.append(_as_met(self.filters().join(keys.select("shard").distinct(), "shard", "left_semi"), _FILTER))
        bits = self.bits

        def run(batches):
            shard, blobs, add, take = None, [], [], []

            def done():
                told = Cuckoo.of(blobs, bits)
                # What goes makes room for what comes.
                told.take(np.concatenate([*take, np.zeros(0, np.int64)]))
                told.add(np.concatenate([*add, np.zeros(0, np.int64)]))
                parts = told.rows()
                return pa.RecordBatch.from_arrays([pa.array([shard[0]] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["shard", "blob"])

            for where, kind, rows in _runs(batches):
                if where != shard:
                    if shard is not None:
                        yield done()
                    shard, blobs, add, take = where, [], [], []
                if kind == _FILTER:
                    blobs.extend(rows.column("blob").to_pylist())
                else:
                    k2, n = _numbers(rows, "k2", "n")
                    add.append(np.repeat(k2, np.maximum(n, 0)))
                    take.append(np.repeat(k2, np.maximum(-n, 0)))
            if shard is not None:
                yield done()

        return _met(*sides).mapInArrow(run, "shard int, blob binary")

    # Questions --------------------------------------------------------------------------------------------------

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of distinct (k1, k2) that the filters may hold: all that are live, and few others."""
        shards, bits = self.shards(), self.bits
        rows = _met(_as_met(self.filters(), _FILTER), _as_met(self._sharded(keys, shards), _ASKED))

        def run(batches):
            shard, blobs, told = None, [], None
            for where, kind, part in _runs(batches):
                if where != shard:
                    shard, blobs, told = where, [], None
                if kind == _FILTER:
                    blobs.extend(part.column("blob").to_pylist())
                    continue
                told = told or Cuckoo.of(blobs, bits)
                k1, k2 = _numbers(part, "k1", "k2")
                some = told.count(k2) > 0
                yield pa.RecordBatch.from_arrays([pa.array(k1[some]), pa.array(k2[some])], ["k1", "k2"])

        return rows.mapInArrow(run, "k1 bigint, k2 bigint")

    def repeated(self, asked: DataFrame) -> DataFrame:
        """doc, row, k1 of those references whose key stands in an earlier document, the key's owner.

        References of a shard are split by document over ``salts`` tasks, each
        with the shard's filter and exact rows, so a key that is in a third of
        all documents fills no task.
        """
        bits, shards, salts = self.bits, self.shards(), F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)))
        filters = self.filters().withColumn("salt", salts)
        table = self._sharded(self.counts().select("k1", "k2", F.col("owner").alias("doc")), shards).withColumn("salt", salts)
        split = self._sharded(asked, shards).withColumn("salt", F.pmod(F.xxhash64("doc", "row"), F.lit(self.salts)))
        rows = _met(_as_met(filters, _FILTER), _as_met(table, _TABLE), _as_met(split, _ASKED))

        def run(batches):
            shard, blobs, held, told = None, [], [], None
            for where, kind, part in _runs(batches):
                if where != shard:
                    shard, blobs, held, told = where, [], [], None
                if kind == _FILTER:
                    blobs.extend(part.column("blob").to_pylist())
                    continue
                numbers = _numbers(part, "k1", "k2", "doc")
                if kind == _TABLE:
                    held.append(numbers)
                    continue
                if told is None:
                    told = Cuckoo.of(blobs, bits)
                    h1, h2, owner = (np.concatenate(c) for c in zip(*held, strict=True)) if held else [np.zeros(0, np.int64)] * 3
                    order = np.lexsort((h2, h1))
                    h1, h2, owner = h1[order], h2[order], owner[order]
                row = part.column("row").to_numpy(zero_copy_only=False)
                # Lines of one document go here; the exact rows decide about the rest.
                twice = np.flatnonzero(told.count(numbers[1]) > 1)
                k1, k2, doc = (c[twice] for c in numbers)
                at, end = np.searchsorted(h1, k1, "left"), np.searchsorted(h1, k1, "right")
                mine = np.full(len(k1), _LAST)
                while (open_ := np.flatnonzero(at < end)).size:
                    hit = open_[h2[at[open_]] == k2[open_]]
                    mine[hit] = owner[at[hit]]
                    at[open_] += 1
                gone = mine < doc
                yield pa.RecordBatch.from_arrays([pa.array(doc[gone]), pa.array(row[twice][gone]), pa.array(k1[gone])], ["doc", "row", "k1"])

        return rows.mapInArrow(run, "doc bigint, row bigint, k1 bigint")

    def kept(self, docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id",), key: str = "doc_id", text: str = "text", asked: DataFrame | None = None) -> DataFrame:
        """The ``carry`` columns of each row, and kept (its text without the lines that an earlier document has), n_lines, n_dropped.

        ``docs`` are documents of the index; ``asked`` are their references
        where the caller has them. A null text is empty and has one empty line.
        """
        asked = references(docs, key=key, text=text) if asked is None else asked
        gone = self.repeated(asked).groupBy("doc", "row").agg(F.collect_set("k1").alias("gone"))
        rows = _identified(docs, key, text, carry).join(gone, ["doc", "row"], "left")
        fields = [f for f in rows.schema.fields if f.name.startswith("carry_")]
        names = [f.name for f in fields]

        def run(batches):
            for batch in batches:
                kept, lines, dropped = [], [], []
                for body, out in zip(batch.column("body").cast(pa.binary()).to_pylist(), batch.column("gone").to_pylist(), strict=True):
                    n, left = body.count(b"\n") + 1, body
                    if out:
                        out = set(out)
                        stay = [line for line in body.split(b"\n") if (k := _key(line)) is None or ((k >> 64) ^ (1 << 63)) - (1 << 63) not in out]
                        left, n_left = b"\n".join(stay), len(stay)
                    kept.append(left)
                    lines.append(n)
                    dropped.append(n - n_left if out else 0)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [*names, "kept", "n_lines", "n_dropped"])

        done = rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", kept string, n_lines bigint, n_dropped bigint")
        return done.select(*[F.col(f"carry_{c}").alias(c) for c in carry], "kept", "n_lines", "n_dropped")


def deduplicate(docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id",), key: str = "doc_id", text: str = "text") -> DataFrame:
    """A table's lines deduplicated through a fresh index of it: see :meth:`Index.kept`.

    A key of at least LEAST code points that two documents hold loses all its
    lines but those of the document with the least id. A document is an id:
    rows that share one are versions of it, none of which outdoes another, and
    each has a row in the result; null ids are one document behind all others.
    Null and empty texts have one empty line, which stays; other columns are
    ignored; an empty table gives an empty result.
    """
    index = Index(docs.sparkSession, scratch(docs.sparkSession, "lines"))
    return index.kept(docs, carry=carry, key=key, text=text, asked=index.insert(docs, key=key, text=text))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))


DIGEST_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_LAST}) AS doc, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owned AS (SELECT k, min(doc) AS owner FROM keyed WHERE length(k) >= {LEAST} GROUP BY k HAVING min(doc) < max(doc)),
told AS (SELECT r, i, line, owner IS NOT NULL AND owner < doc AS gone FROM keyed LEFT JOIN owned USING (k))
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM docs JOIN (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM told GROUP BY r) USING (r)
"""
