"""Benchmark decontamination with a generalised suffix automaton.

The normalised items go into one automaton over words. Training tokens are
streamed through it while the longest matching length is tracked; wherever it
reaches the window length, the window's words are hit and the state tells the
items. Tokens are hashed in array passes first, and only stretches whose every
word pair occurs in some item are walked, since a match can lie nowhere else.

Items beyond one automaton's size are never gathered. Windows of items and of
documents are dealt alike, by the least hash of their word pairs, so that each
part has an automaton of its own runs of windows, and only the stretches of
documents that a filter of all items' word pairs passes meet it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.scalars import once
from . import kernels as K
from .common import bitmap, cut, without

WINDOW = 10
#: Words of items that one automaton holds, so that what is broadcast is bounded; more items take more automata.
PART_WORDS = 100_000
_BITS = 22
#: Words of documents that one task matches with one part, and windows of one run of them.
TASK_WORDS, RUN_WINDOWS = 2_000_000, 4096
#: Bytes of sizes of parts up to which they are broadcast.
SIZES = 16 << 20


class SuffixAutomaton:
    """Generalised suffix automaton of sequences of integers."""

    def __init__(self, items: list[list[int]], window: int = WINDOW):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.window = window
        ends: list[tuple[int, int]] = []
        self.whole: dict[int, list[int]] = {}
        for k, item in enumerate(items):
            last = 0
            for word in item:
                last = self._extend(last, word)
                ends.append((last, k))
        # Items of each state: those of the states below it in the link tree.
        self.items: list[set[int]] = [set() for _ in self.next]
        for state, k in ends:
            while state > 0 and k not in self.items[state]:
                self.items[state].add(k)
                state = self.link[state]
        # Short items are hit as a whole: where their state is reached with their length.
        for k, item in enumerate(items):
            if 0 < len(item) < window:
                state = 0
                for word in item:
                    state = self.next[state][word]
                self.whole.setdefault(state, []).append(k)
        self.sizes = [len(item) for item in items]
        self.shorts: list[list[int]] = [[] for _ in self.next]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.shorts[state] = self.shorts[self.link[state]] + self.whole.get(state, [])

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of p's longest string and the word, made apart from longer ones if need be."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        now = self._new(self.length[last] + 1, 0, {})
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = now
            p = self.link[p]
        if p != -1:
            self.link[now] = self._split(p, word)
        return now

    def matches(self, words: list[int]):
        """(end, length, items) of each window or short item that ends at a word."""
        state = size = 0
        following, link, length = self.next, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                size = length[state]
            to = following[state].get(word)
            if to is None:
                state = size = 0
                continue
            state, size = to, size + 1
            if size >= self.window:
                top = state
                while length[link[top]] >= self.window:
                    top = link[top]
                yield i + 1, self.window, self.items[top]
            for k in self.shorts[state]:
                if self.sizes[k] <= size:
                    yield i + 1, self.sizes[k], (k,)


def word_pairs(words: np.ndarray, least: int) -> np.ndarray:
    """Hashes of neighbouring words; the words themselves where a window may be a single one."""
    return words if least < 2 else K.mix64(words[:-1] * K._ODD + words[1:])


def stretches(maybe: np.ndarray, row: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first word, end word) of runs of passed pairs within a row, of ``least`` words or more."""
    if least > 1:
        maybe = maybe & (row[1:] == row[:-1])
    at = np.flatnonzero(maybe)
    if not len(at):
        return []
    breaks = np.flatnonzero((np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]]))
    first, last = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(at) - 1]))
    extra = 1 if least < 2 else 2
    long = last - first + extra >= least
    return list(zip(at[first[long]].tolist(), (at[last[long]] + extra).tolist(), strict=True))


@dataclass
class Part:
    """What one automaton is made of: ids and word hashes of items."""

    ids: list
    words: list[np.ndarray]
    window: int


class Matcher:
    def __init__(self, part: Part):
        self.ids = part.ids
        vocabulary = {h: n for n, h in enumerate(sorted({int(h) for w in part.words for h in w}))}
        self.automaton = SuffixAutomaton([[vocabulary[int(h)] for h in w] for w in part.words], part.window)
        self.vocabulary = np.array(sorted(vocabulary), K.U)
        self.least = min((min(len(w), part.window) for w in part.words), default=1)
        grams = [word_pairs(w, self.least) for w in part.words]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, K.U)
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.grams >> K.U(64 - _BITS)).astype(np.int64)] = True

    def hits(self, words: np.ndarray, row: np.ndarray):
        """(first word, end word, items) of matches, by word of the pass."""
        if len(words) < self.least or not len(self.grams):
            return
        grams = word_pairs(words, self.least)
        maybe = self.filter[(grams >> K.U(64 - _BITS)).astype(np.int64)]
        at = np.flatnonzero(maybe)
        maybe[at] = self.grams[np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)] == grams[at]
        for a, b in stretches(maybe, row, self.least):
            ids = np.searchsorted(self.vocabulary, words[a:b]).tolist()
            for end, size, items in self.automaton.matches(ids):
                yield a + end - size, a + end, items


_BUILT: dict[int, Matcher] = {}


def _matcher(broadcast) -> Matcher:
    """Built once in each Python worker."""
    part = broadcast.value
    key = hash((part.window, tuple(part.ids), *(w.tobytes() for w in part.words)))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Matcher(part)
    return _BUILT[key]


def item_words(text: str | None) -> np.ndarray:
    data, offsets = K.text_bytes(pa.array([text], pa.string()))
    starts, ends, _ = K.word_spans(data, offsets, K.ALNUM)
    return K.word_hashes(data, starts, ends)


def one_part(items: DataFrame, window: int) -> Part:
    """All items; only for those of a checked size."""
    told = [(r.id, item_words(r.text)) for r in items.toLocalIterator()]
    told = [(k, w) for k, w in told if len(w)]
    return Part([k for k, _ in told], [w for _, w in told], window)


_HITS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("char_from", pa.int32()), ("char_to", pa.int32())]))
_ADDED = [StructField("n_words", LongType()), StructField("hits", ArrayType(StructType([StructField(f, IntegerType()) for f in ("from", "to", "char_from", "char_to")]))), StructField("items", ArrayType(StringType()))]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find(docs: DataFrame, benchmark: DataFrame, *, carry: tuple[str, ...] = ("doc_id",), text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, part_words: int = PART_WORDS) -> DataFrame:
    """The ``carry`` columns of each document and n_words, hits (runs of hit words and their characters), items (ids).

    An item of fewer words than the window, but not none, is one window. Null
    or empty texts have no words; repeated documents give repeated rows; items
    that share an id count once; null item ids stand as the empty string; other
    columns are ignored. Items of up to ``part_words`` words are broadcast as
    one automaton; more are dealt to parts on the executors.
    """
    items = benchmark.select(F.col(item_key).cast("string").alias("id"), F.col(item_text).cast("string").alias("text"))
    # Half of the characters bounds the words.
    total = int(items.agg(F.coalesce(F.sum(F.ceil((F.length("text") + 1) / 2)), F.lit(0)).alias("n")).first()["n"])
    rows = docs.select(F.col(text).cast("string").alias("text_"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    told = [F.col(f"carry_{c}").alias(c) for c in carry]
    if total > part_words:
        return _dealt_hits(rows, items, total, window, part_words).select(*told, "n_words", "hits", "items")
    held = docs.sparkSession.sparkContext.broadcast(one_part(items, window))
    schema = StructType([f for f in rows.schema.fields if f.name.startswith("carry_")] + _ADDED)
    # A text that is carried anyway travels once.
    read = f"carry_{text}" if text in carry and isinstance(rows.schema[f"carry_{text}"].dataType, StringType) else "text_"
    rows = rows.drop("text_") if read != "text_" else rows

    def run(batches, names=tuple(f"carry_{c}" for c in carry), told=to_arrow_schema(schema)):
        matcher = _matcher(held)
        for batch in batches:
            data, offsets = K.text_bytes(batch.column(read))
            # A batch for each pass, so that no more is held of what goes back.
            for a, b in K.passes(offsets):
                counts, hits, items = _scan(matcher, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a).cast(told.field(c).type) for c in names), pa.array(counts, pa.int64()), pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string()))], schema=told)
            # What the next batch doesn't need isn't kept beside it.
            del batch, data, offsets
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema).select(*told, "n_words", "hits", "items")


def runs_of_windows(words: np.ndarray, size: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, end window, part) of runs of windows of ``size`` words that go to one part: by the least hash of their pairs."""
    pairs = word_pairs(words, size)
    if size > 2:
        pairs = np.lib.stride_tricks.sliding_window_view(pairs, size - 1).min(axis=1)
    part = (K.mix64(pairs) % K.U(count)).astype(np.int64)
    firsts = np.unique(np.concatenate((np.arange(0, len(part), RUN_WINDOWS), np.flatnonzero(np.diff(part)) + 1)))
    return firsts, np.append(firsts[1:], len(part)), part[firsts]


def _lists(pieces: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, pieces)])
    values = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _item_runs(window: int, count: int):
    """(size, part, id, words) of the runs of windows of each item."""

    def told(out):
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), _lists(out[3], pa.int64())], names=["size", "part", "id", "words"])

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            held = 0
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = item_words(text)
                n = min(len(words), window)
                for a, b, part in zip(*runs_of_windows(words, n, count), strict=True) if n else ():
                    for column, value in zip(out, (n, int(part), key, words[a : b + n - 1].view(np.int64)), strict=True):
                        column.append(value)
                held += len(words)
                if held > TASK_WORDS:
                    yield told(out)
                    out, held = [[], [], [], []], 0
            yield told(out)

    return run


def _pairs_of(least: int):
    """Hashes of the word pairs of a batch of runs."""

    def run(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([np.zeros(0, K.U), *(word_pairs(words.values.to_numpy().view(K.U), least) for words in batch.column("words"))])

    return run


def _document_runs(held, sizes: tuple[int, ...], bits: int, count: int):
    """(size, part, key, from, words, starts, ends) of the runs of windows of what the filter passes; starts and ends are characters."""
    least = sizes[0]

    def run(batches):
        bits_held = held.value
        for batch in batches:
            keys = batch.column("key").to_pylist()
            data, offsets = K.text_bytes(batch.column("text_"))
            for a, b in K.passes(offsets):
                local, here = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                starts, ends, row = K.word_spans(local, here, K.ALNUM)
                if len(starts) < least:
                    continue
                words = K.word_hashes(local, starts, ends)
                passed = stretches(K.bits_set(bits_held, word_pairs(words, least), bits), row, least)
                if not passed:
                    continue
                chars = np.concatenate(([0], np.cumsum((local & 0xC0) != 0x80)))
                first_word = np.searchsorted(row, np.arange(b - a))
                out: list[list] = [[] for _ in range(7)]
                for x, y in passed:
                    r = int(row[x])
                    for n in sizes:
                        if y - x < n:
                            break
                        for f, e, part in zip(*runs_of_windows(words[x:y], n, count), strict=True):
                            f, e = x + int(f), x + int(e) + n - 1
                            told = (n, int(part), keys[a + r], f - int(first_word[r]), words[f:e].view(np.int64), chars[starts[f:e]] - chars[here[r]], chars[ends[f:e]] - chars[here[r]])
                            for column, value in zip(out, told, strict=True):
                                column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), _lists(out[4], pa.int64()), _lists(out[5], pa.int32()), _lists(out[6], pa.int32())],
                    names=["size", "part", "key", "from", "words", "starts", "ends"],
                )

    return run


_GROUP = ("part", "size", "sub", "salt")


def _match(batches):
    """Hits by run of a document. Rows come by group, the items' runs first; a group's automaton stays until the next one begins."""
    group, ids, held, matcher = None, [], [], None
    for batch in batches:
        told = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*_GROUP, "kind")])
        edges = [0, *(np.flatnonzero((np.diff(told) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        keys, hits, items = [], [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            now, kind = tuple(told[:-1, a].tolist()), told[-1, a]
            if now != group:
                group, ids, held, matcher = now, [], [], None
            lists = batch.column("words").slice(a, b - a)
            flat = lists.flatten().to_numpy().view(K.U)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            if not kind:
                ids += batch.column("id").slice(a, b - a).to_pylist()
                held += [flat[x:y].copy() for x, y in zip(at[:-1], at[1:], strict=True)]
                continue
            if matcher is None:
                matcher = Matcher(Part(ids, held, now[1]))
            key, from_ = (batch.column(c).slice(a, b - a).to_pylist() for c in ("key", "from"))
            starts, ends = (batch.column(c).slice(a, b - a).flatten().to_numpy() for c in ("starts", "ends"))
            found: dict[int, tuple[list, set]] = {}
            row = np.repeat(np.arange(b - a), np.diff(at))
            for x, y, which in matcher.hits(flat, row):
                spans, names = found.setdefault(int(row[x]), ([], set()))
                spans.append((x, y))
                names.update(which)
            for r, (spans, names) in found.items():
                move = from_[r] - int(at[r])
                keys.append(key[r])
                hits.append([{"from": x + move, "to": y + move, "char_from": int(starts[x]), "char_to": int(ends[y - 1])} for x, y in _merge(spans)])
                items.append(sorted({matcher.ids[k] or "" for k in names}))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string()))], names=["key", "hits", "items"])


def _joined_hits(batches):
    for batch in batches:
        out = []
        for hits in batch.column("hits").to_pylist():
            at, to = {h["from"]: h["char_from"] for h in hits}, {h["to"]: h["char_to"] for h in hits}
            out.append([{"from": x, "to": y, "char_from": at[x], "char_to": to[y]} for x, y in _merge([(h["from"], h["to"]) for h in hits])])
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, _HITS), batch.column("items").cast(pa.list_(pa.string()))], names=["key", "hits", "items"])


def _dealt_hits(rows: DataFrame, items: DataFrame, total: int, window: int, part_words: int) -> DataFrame:
    """The rows with n_words, hits and items, by parts on the executors.

    A part whose items or documents are many is split: its items' runs into
    further automata, its documents' runs over tasks that each get the items.
    """
    sc = rows.sparkSession.sparkContext
    count = -(-3 * total // part_words)
    ours = items.distinct().mapInArrow(_item_runs(window, count), "size int, part bigint, id string, words array<bigint>")
    ours = cut(ours.distinct())
    # Sizes are window lengths, ten at most.
    sizes = tuple(sorted(r["size"] for r in ours.select("size").distinct().collect()))
    none = F.array().cast(_ADDED[1].dataType), F.array().cast("array<string>")
    counted = rows.withColumn("key", F.xxhash64("text_"))
    names = [c for c in rows.columns if c.startswith("carry_")]
    schema = StructType([*(rows.schema[c] for c in names), StructField("key", LongType()), StructField("n_words", LongType())])

    def count_words(batches, told=to_arrow_schema(schema)):
        for batch in batches:
            data, offsets = K.text_bytes(batch.column("text_"))
            n = np.zeros(batch.num_rows, np.int64)
            for a, b in K.passes(offsets):
                _, _, row = K.word_spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], K.ALNUM)
                n[a:b] = np.bincount(row, minlength=b - a)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).cast(told.field(c).type) for c in (*names, "key")), pa.array(n)], schema=told)

    with_counts = counted.mapInArrow(count_words, schema)
    if not sizes:
        return with_counts.select("*", none[0].alias("hits"), none[1].alias("items"))
    filled, width = bitmap(ours, _pairs_of(sizes[0]), total)
    held = sc.broadcast(filled)
    theirs = counted.select("key", "text_").mapInArrow(_document_runs(held, sizes, width, count), "size int, part bigint, key bigint, from int, words array<bigint>, starts array<int>, ends array<int>")
    # Copies of a text are matched once.
    theirs = cut(theirs.dropDuplicates(["key", "from", "size", "part"]))
    weight = lambda df, name: df.groupBy("part", "size").agg(F.sum(F.size("words")).alias(name))
    split = weight(ours, "in_items").join(weight(theirs, "in_texts"), ["part", "size"]).select(
        "part", "size", F.ceil(F.col("in_items") / part_words).alias("subs"), F.ceil(F.col("in_texts") / TASK_WORDS).alias("salts")
    )
    if count * len(sizes) * 64 <= SIZES:
        split = F.broadcast(split)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    own = lambda n, *c: F.pmod(F.xxhash64(*c), F.col(n)).cast("int")
    ints = F.lit(None).cast("array<int>")
    dealt = ours.join(split, ["part", "size"]).select("part", "size", own("subs", "id", "words").alias("sub"), each("salts").alias("salt"), F.lit(0).alias("kind"), "id", F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("int").alias("from"), "words", ints.alias("starts"), ints.alias("ends"))
    met = theirs.join(split, ["part", "size"]).select("part", "size", each("subs").alias("sub"), own("salts", "key", "from").alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("id"), "key", "from", "words", "starts", "ends")
    grouped = dealt.unionByName(met).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "kind")
    found = grouped.mapInArrow(_match, StructType([StructField("key", LongType()), *_ADDED[1:]])).groupBy("key").agg(
        F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    found = found.mapInArrow(_joined_hits, StructType([StructField("key", LongType()), *_ADDED[1:]]))
    return with_counts.join(found, "key", "left").select(*names, "n_words", F.coalesce("hits", none[0]).alias("hits"), F.coalesce("items", none[1]).alias("items"))


def _scan(matcher: Matcher, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list, list]:
    """Word counts, hit runs and item ids of each row."""
    counts, hits, items = [], [], []
    for a, b in K.passes(offsets):
        base = offsets[a]
        local, here = data[base : offsets[b]], offsets[a : b + 1] - base
        starts, ends, row = K.word_spans(local, here, K.ALNUM)
        words = K.word_hashes(local, starts, ends)
        per = np.bincount(row, minlength=b - a)
        first = np.concatenate(([0], np.cumsum(per)))
        counts.extend(per.tolist())
        found: dict[int, tuple[list, set]] = {}
        for x, y, ids in matcher.hits(words, row):
            spans, names = found.setdefault(int(row[x]), ([], set()))
            spans.append((x, y))
            names.update(ids)
        for r in range(b - a):
            if r not in found:
                hits.append([])
                items.append([])
                continue
            raw = local[here[r] : here[r + 1]]
            chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            hits.append([
                {"from": x - int(first[r]), "to": y - int(first[r]), "char_from": int(chars[starts[x] - here[r]]), "char_to": int(chars[ends[y - 1] - here[r]])}
                for x, y in _merge(found[r][0])
            ])
            items.append(sorted({matcher.ids[k] or "" for k in found[r][1]}))
    return counts, hits, items


def n_hit() -> F.Column:
    return F.aggregate("hits", F.lit(0), lambda a, h: a + h["to"] - h["from"]).cast("bigint")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"),
    )


def cleaned(found: DataFrame, *, most_length: int = 0, most_coverage: float = 0.5) -> DataFrame:
    """``found`` (with its text carried) with texts freed of hit runs longer than ``most_length`` words.

    Texts of which more than ``most_coverage`` of the words are hit go.
    """
    kept = found.where(n_hit() <= most_coverage * F.col("n_words"))
    # Hits are runs in order, apart.
    spans = F.transform(F.filter("hits", lambda h: h["to"] - h["from"] > most_length), lambda h: F.struct(h["char_from"].alias("start"), h["char_to"].alias("end")))
    return kept.withColumn("text", once(spans, lambda runs: without(F.col("text"), runs)))


DIGEST_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), item_window AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS id, n, array_to_string(w[i : i + n - 1], ' ') AS said
  FROM (SELECT item_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM item)
), doc_window AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS said
  FROM (SELECT r, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM doc CROSS JOIN (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)
), hit AS (SELECT d.r, d.i, d.n, k.id FROM doc_window d JOIN item_window k USING (n, said)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY encode(id))) AS items_sha256 FROM (SELECT DISTINCT r, id FROM hit) GROUP BY r)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit, coalesce(ids.n_items, 0) AS n_items,
  coalesce(ids.items_sha256, sha256('')) AS items_sha256, coalesce(words.n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
"""
