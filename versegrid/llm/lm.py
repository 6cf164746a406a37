"""Language-model scoring with a log-bilinear model.

The next word is scored by the product of its vector with a context vector
that is bilinear in the two words before. The vocabulary grows with the
corpus: its frequent words have vectors of their own, as targets and as
contexts, and all other words share those of their hash bucket, within which a
word has its smoothed unigram share; so every word gets a prediction and lends
a context. Words and buckets are the leaves of a tree of two layers, dealt to
groups by frequency: a group is chosen, then a leaf of it. Both choices are
trained in numpy by noise-contrastive estimation, whose noise is the unigram
distribution; a short start on a bounded sample is followed by a round over
the whole training corpus, in which each task goes on from the common
parameters over its own texts and the results are averaged by tokens. Matrix
products over the contexts of a batch, one for the groups and one for each
group's leaves, give the exact normalisers, so probabilities add up to one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut

#: Words with vectors of their own: so many times the cube root of the corpus's tokens, this many at least; hash buckets for the rest, a share of that.
WORDS_ROOT, LEAST_WORDS, BUCKET_SHARE = 8.0, 256, 0.25
#: Vector length, noise samples of groups and of each group's leaves, and tokens of a step.
WIDTH, NOISE, LEAF_NOISE, STEP = 24, 24, 6, 8192
#: Training texts of the start, about, and steps over them at least, in whole passes.
START_TEXTS, START_STEPS = 1500, 300
#: Frequent words whose counts are broadcast (12 bytes each); the counts of all others meet their texts in a join.
HEAD = 500_000
#: Numbers of a part of the parameters, and partial sums of each part, which are averaged apart.
PART, GROUPS = 1 << 16, 16
#: The end of a text as a token; no word has this hash but by chance.
END_HASH = int(np.int64(np.uint64(0xE0D0_7E87_0000_0001).astype(np.int64)))


def held_out(key: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold


def tokens(column: pa.Array):
    """(rows from, to, token hashes, row of each): the words of each text, then its end."""
    data, offsets = K.text_bytes(column)
    for a, b in K.passes(offsets):
        local, here = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, row = K.word_spans(local, here, K.NOT_SPACE)
        h = K.word_hashes(local, starts, ends).view(np.int64)
        last = np.cumsum(np.bincount(row, minlength=b - a))
        yield a, b, np.insert(h, last, END_HASH), np.insert(row, last, np.arange(b - a))


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c) over all tokens of (text) rows; each task sends a word once for many texts."""

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for _, _, h, _ in tokens(batch.column(0)):
                parts.append(np.unique(h, return_counts=True))
                n += len(parts[-1][0])
                if n > 2_000_000:
                    yield _summed(parts)
                    parts, n = [], 0
        if parts:
            yield _summed(parts)

    return texts.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def _summed(parts):
    h, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    values, where = np.unique(h, return_inverse=True)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(np.bincount(where, c, len(values)).astype(np.int64))], names=["h", "c"])


@dataclass
class Tree:
    """Leaves in order of frequency, and the groups of neighbours that they are dealt to."""

    share: np.ndarray
    group: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, amount: np.ndarray) -> Tree:
        """Groups, as many as the root of the leaves, hold about equal sums of the roots of their leaves' counts."""
        share = (amount + 0.5) / (amount + 0.5).sum()
        upto = np.cumsum(np.sqrt(share))
        group = np.unique(np.floor((upto - np.sqrt(share) / 2) / upto[-1] * np.ceil(np.sqrt(len(share)))), return_inverse=True)[1]
        return cls(share, group, np.searchsorted(group, np.arange(group[-1] + 2)))

    @property
    def groups(self) -> int:
        return len(self.first) - 1

    @property
    def group_share(self) -> np.ndarray:
        return np.add.reduceat(self.share, self.first[:-1])


@dataclass
class Parameters:
    """Vectors and biases of groups and leaves, context vectors of leaves (one more for the start), weights of both places."""

    group: np.ndarray
    group_bias: np.ndarray
    leaf: np.ndarray
    leaf_bias: np.ndarray
    context: np.ndarray
    places: np.ndarray

    @classmethod
    def start(cls, tree: Tree) -> Parameters:
        rng, n = np.random.default_rng(5), len(tree.share)
        some = lambda m: (rng.standard_normal((m, WIDTH)) * 0.1).astype(np.float32)
        within = tree.share / tree.group_share[tree.group]
        return cls(some(tree.groups), np.log(tree.group_share).astype(np.float32), some(n), np.log(within).astype(np.float32), some(n + 1), np.ones((2, WIDTH), np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [self.group, self.group_bias, self.leaf, self.leaf_bias, self.context, self.places]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def shaped(self, flat: np.ndarray) -> Parameters:
        out, at = [], 0
        for a in self.arrays():
            out.append(flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Parameters(*out)

    def predicted(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[before] * self.places[0] + self.context[last] * self.places[1]


def _summed_rows(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct indices, sums of their rows)."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
    return index[first], np.add.reduceat(rows[order], first, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -30, 30)))


class Trainer:
    """Noise-contrastive estimation with AdaGrad; a step shares its noise groups, and its noise leaves by group."""

    def __init__(self, p: Parameters, tree: Tree, rate: float, seed: int, squares: list[np.ndarray] | None = None):
        self.p, self.rate, self.tree = Parameters(*[a.copy() for a in p.arrays()]), rate, tree
        self.rng = np.random.default_rng(seed)
        self.squares = [a.copy() for a in squares] if squares else [np.full(a.shape, 1e-9, np.float32) for a in p.arrays()]
        share = tree.group_share
        self.upto_group, self.upto = np.cumsum(share), np.cumsum(tree.share)
        self.log_group = np.log(NOISE * share).astype(np.float32)
        self.log_leaf = np.log(LEAF_NOISE * tree.share / share[tree.group]).astype(np.float32)
        self.many = (np.diff(tree.first) > 1).astype(np.float32)

    def _drawn(self) -> tuple[np.ndarray, np.ndarray]:
        """Noise groups, and noise leaves of each group."""
        t = self.tree
        groups = np.minimum(np.searchsorted(self.upto_group, self.rng.random(NOISE) * self.upto_group[-1]), t.groups - 1)
        low = self.upto_group - t.group_share
        spot = low[:, None] + self.rng.random((t.groups, LEAF_NOISE)) * t.group_share[:, None]
        return groups, np.clip(np.searchsorted(self.upto, spot), t.first[:-1, None], t.first[1:, None] - 1)

    def _ascend(self, which: int, at, gradient: np.ndarray) -> None:
        array, square = self.p.arrays()[which], self.squares[which]
        gradient = gradient.astype(np.float32)
        square[at] += gradient * gradient
        array[at] += self.rate * gradient / np.sqrt(square[at])

    def step(self, before: np.ndarray, last: np.ndarray, leaf: np.ndarray) -> None:
        p, m = self.p, len(leaf)
        order = np.argsort(self.tree.group[leaf], kind="stable")
        before, last, leaf = before[order], last[order], leaf[order]
        group = self.tree.group[leaf]
        noise, noise_leaf = self._drawn()
        c1, c2 = p.context[before], p.context[last]
        r = c1 * p.places[0] + c2 * p.places[1]
        # Ascent: d log sigma(real) and d log(1 - sigma(fake)); first the groups.
        up = 1 - _sigmoid(np.einsum("ij,ij->i", r, p.group[group]) + p.group_bias[group] - self.log_group[group])
        down = _sigmoid(r @ p.group[noise].T + p.group_bias[noise] - self.log_group[noise])
        g_r = up[:, None] * p.group[group] - down @ p.group[noise]
        g_group = np.zeros_like(p.group)
        present = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        g_group[group[present]] = np.add.reduceat(up[:, None] * r, present, axis=0)
        np.add.at(g_group, noise, -(down.T @ r))
        g_group_bias = np.bincount(group, up, self.tree.groups) - np.bincount(noise, down.sum(axis=0), self.tree.groups)
        # Then the leaves within them; a group of one leaves nothing to choose.
        many = self.many[group]
        up = many * (1 - _sigmoid(np.einsum("ij,ij->i", r, p.leaf[leaf]) + p.leaf_bias[leaf] - self.log_leaf[leaf]))
        other = p.leaf[noise_leaf]
        fake = np.empty((m, LEAF_NOISE), np.float32)
        ends = np.concatenate((present[1:], [m]))
        pushed = np.zeros((len(present), LEAF_NOISE, WIDTH), np.float32)
        g_r += up[:, None] * p.leaf[leaf]
        for k, (a, b) in enumerate(zip(present, ends, strict=True)):
            g = group[a]
            if self.many[g]:
                fake[a:b] = _sigmoid(r[a:b] @ other[g].T + p.leaf_bias[noise_leaf[g]] - self.log_leaf[noise_leaf[g]])
                g_r[a:b] -= fake[a:b] @ other[g]
                pushed[k] = fake[a:b].T @ r[a:b]
            else:
                fake[a:b] = 0
        drawn = noise_leaf[group[present]].ravel()
        rows, g_leaf = _summed_rows(np.concatenate((leaf, drawn)), np.concatenate((up[:, None] * r, -pushed.reshape(-1, WIDTH))))
        _, g_leaf_bias = _summed_rows(np.concatenate((leaf, drawn)), np.concatenate((up, -np.add.reduceat(fake, present, axis=0).ravel()))[:, None])
        seen, g_context = _summed_rows(np.concatenate((before, last)), np.concatenate((g_r * p.places[0], g_r * p.places[1])))
        g_places = np.stack(((g_r * c1).sum(axis=0), (g_r * c2).sum(axis=0)))
        every = slice(None)
        for which, at, g in ((0, every, g_group), (1, every, g_group_bias), (2, rows, g_leaf), (3, rows, g_leaf_bias[:, 0]), (4, seen, g_context), (5, every, g_places)):
            self._ascend(which, at, g / m)

    def texts(self, leaves: np.ndarray, row: np.ndarray, size: int = STEP) -> None:
        before, last = contexts(leaves, row, len(self.p.leaf_bias))
        for a in range(0, len(leaves), size):
            self.step(before[a : a + size], last[a : a + size], leaves[a : a + size])


def contexts(leaves: np.ndarray, row: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the two tokens before each, the start's number where there is none."""
    last, before = np.full(len(leaves), start), np.full(len(leaves), start)
    last[1:] = np.where(row[1:] == row[:-1], leaves[:-1], start)
    before[2:] = np.where(row[2:] == row[:-2], leaves[:-2], start)
    return before, last


def _log_choice(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at its chosen column."""
    top = scores.max(axis=1)
    return scores[np.arange(len(scores)), chosen] - top - np.log(np.exp(scores - top[:, None]).sum(axis=1))


@dataclass
class Model:
    #: Sorted hashes of the words that have a leaf, their leaves and counts; the leaf of each bucket.
    words: np.ndarray
    numbers: np.ndarray
    amount: np.ndarray
    buckets: np.ndarray
    #: Natural log of what the smoothed counts of a bucket's words are divided by.
    bucket_norm: np.ndarray
    tree: Tree
    parameters: Parameters
    tokens: int
    distinct: int
    #: Sums of squared gradients of the start, from which the round over all texts goes on.
    squares: list[np.ndarray] | None = None

    def leaves(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf of each token, log of the divisor of its share within the leaf; 0 for words with a leaf of their own)."""
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        own = self.words[at] == h
        bucket = np.mod(h, len(self.buckets))
        return np.where(own, self.numbers[at], self.buckets[bucket]), np.where(own, 0.0, self.bucket_norm[bucket])

    def own(self, h: np.ndarray) -> np.ndarray:
        return self.words[np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)] == h

    def log_probability(self, leaves: np.ndarray, row: np.ndarray, size: int = 1 << 16) -> np.ndarray:
        """Natural log of each token's leaf after its context."""
        p, t = self.parameters, self.tree
        before, last = contexts(leaves, row, len(p.leaf_bias))
        out = np.empty(len(leaves))
        for a in range(0, len(leaves), size):
            order = np.argsort(t.group[leaves[a : a + size]], kind="stable") + a
            leaf, r = leaves[order], p.predicted(before[order], last[order])
            group = t.group[leaf]
            told = np.empty(len(order))
            for low in range(0, len(order), 4096):
                told[low : low + 4096] = _log_choice(r[low : low + 4096] @ p.group.T + p.group_bias, group[low : low + 4096])
            edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                first, end = t.first[group[low]], t.first[group[low] + 1]
                # Few contexts at a time, so that the scores of a large group stay small.
                rows = max(64, (1 << 20) // (end - first))
                for x in range(low, high if end - first > 1 else low, rows):
                    y = min(high, x + rows)
                    told[x:y] += _log_choice(r[x:y] @ p.leaf[first:end].T + p.leaf_bias[first:end], leaf[x:y] - first)
            out[order] = told
        return out


def _mixed(texts: DataFrame, model: Model, rate: float) -> Parameters:
    """One round over all texts: tasks train on from the common parameters; the average by tokens.

    Parameters travel in parts, weighted and rounded to whole numbers, whose
    sums are the same in any order.
    """
    held = texts.sparkSession.sparkContext.broadcast(model)
    schema = "part int, n bigint, flat binary"
    row = lambda part, n, raw: pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([raw], pa.binary())], names=["part", "n", "flat"])

    def train(batches):
        m = held.value
        trainer, n, seed = None, 0, 1
        for batch in batches:
            for _, _, h, at in tokens(batch.column(0)):
                if trainer is None:
                    seed = int(np.bitwise_xor.reduce(h[:100]) & 0x7FFFFFFF)
                    trainer = Trainer(m.parameters, m.tree, rate, seed, m.squares)
                trainer.texts(m.leaves(h)[0], at)
                n += len(h)
        if trainer is not None:
            flat, weight = trainer.p.flat(), max(1, n >> 10)
            for i, low in enumerate(range(0, len(flat), PART)):
                yield row(i * GROUPS + seed % GROUPS, weight, flat[low : low + PART].astype(np.float32).tobytes())

    def add(batches):
        totals, weights = {}, {}
        for batch in batches:
            for part, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.rint(np.frombuffer(raw, np.float32).astype(np.float64) * (1 << 20)).astype(np.int64) * n
                totals[part] = totals[part] + x if part in totals else x
                weights[part] = weights.get(part, 0) + n
        for part, x in totals.items():
            yield row(part, weights[part], x.tobytes())

    whole = model.parameters.flat()
    parts = -(-len(whole) // PART)
    sums, weights = np.zeros(len(whole), object), np.zeros(parts, object)
    for r in texts.mapInArrow(train, schema).repartition(GROUPS, "part").mapInArrow(add, schema).toLocalIterator():
        i = r["part"] // GROUPS
        sums[i * PART : (i + 1) * PART] += np.frombuffer(r["flat"], np.int64).astype(object)
        weights[i] += r["n"]
    if not weights[0]:
        return model.parameters
    return model.parameters.shaped(np.array([float(x) for x in sums]) / (1 << 20) / np.repeat(weights.astype(np.float64), PART)[: len(whole)])


def frequent(counts: DataFrame, most: int, least: int = 0) -> DataFrame:
    """The most frequent words, ``most`` at most but for ``least``: those above a count that a histogram of counts tells.

    Counts are summed up by an eighth of a power of two, a few hundred bins in
    all, so no task sorts or gathers words.
    """
    step = F.floor(F.log2("c") * 8).cast("int")
    bins = counts.groupBy(step.alias("b")).agg(F.count("*").alias("n")).orderBy(F.desc("b")).collect()
    total, low = 0, None
    for r in bins:
        if total >= least and total + r["n"] > most:
            break
        total, low = total + r["n"], r["b"]
    return counts.where(step >= low) if low is not None else counts.limit(0)


def vocabulary(n: int) -> int:
    """Words with vectors of their own, for a corpus of so many tokens."""
    return max(LEAST_WORDS, round(WORDS_ROOT * n ** (1 / 3)))


def fit(docs: DataFrame, counts: DataFrame, *, key: str = "doc_id", text: str = "text", words: int | None = None, rate: float = 0.05) -> Model | None:
    """Train on the rows that aren't held out; None without any token. ``words`` is :func:`vocabulary` of the tokens unless told."""
    told = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    if not told["n"]:
        return None
    words = words or vocabulary(told["n"])
    buckets = max(16, int(words * BUCKET_SHARE))
    known = frequent(counts, 4 * words, words).where(F.col("h") != END_HASH).orderBy(F.desc("c"), "h").limit(words - 1)
    top = known.toArrow()
    ends = counts.where(F.col("h") == END_HASH).first()["c"]
    hashes, amount = np.concatenate(([END_HASH], top.column("h").to_numpy())), np.concatenate(([ends], top.column("c").to_numpy()))
    mine = docs.sparkSession.createDataFrame([(int(h),) for h in hashes], "h bigint")
    rest = counts.join(F.broadcast(mine), "h", "left_anti").groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()
    inside, kinds = np.zeros(buckets), np.zeros(buckets)
    inside[rest.column("b").to_numpy()], kinds[rest.column("b").to_numpy()] = rest.column("n").to_numpy(), rest.column("v").to_numpy()
    every = np.concatenate((amount, inside))
    place = np.empty(len(every), np.int64)
    by_count = np.argsort(-every, kind="stable")
    place[by_count] = np.arange(len(every))
    tree = Tree.of(every[by_count])
    order = np.argsort(hashes)
    model = Model(hashes[order], place[: len(hashes)][order], amount[order].astype(np.float64), place[len(hashes) :], np.log(inside + 0.5 * (kinds + 1)), tree, Parameters.start(tree), told["n"], told["v"])
    training = docs.where(~held_out(F.col(key))).select(F.col(text).cast("string").alias("text"), F.xxhash64(F.col(key), F.lit("start")).alias("r"))
    rows = training.count()
    limit = F.lit(min(1.0, START_TEXTS / max(1, rows)) * float(1 << 62))
    start = training.where(F.pmod("r", F.lit(1 << 62)) < limit).select("text", "r")
    parts = [np.array(r["c"], np.int64) for r in sorted(_leaf_rows(start, model).toLocalIterator(), key=lambda r: (r["r"], r["c"]))]
    if parts:
        trainer = Trainer(model.parameters, tree, rate, 1)
        sequence, row = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        size = max(256, min(STEP, len(sequence) // 64))
        for _ in range(max(1, -(-START_STEPS * size // len(sequence)))):
            trainer.texts(sequence, row, size)
        model = replace(model, parameters=trainer.p, squares=trainer.squares)
    return replace(model, parameters=_mixed(training.select("text"), model, rate), squares=None)


def _leaf_rows(texts: DataFrame, model: Model) -> DataFrame:
    """(r, c): the leaves of each text of the start's bounded sample."""
    held = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for a, b, h, row in tokens(batch.column(0)):
                c = held.value.leaves(h)[0].astype(np.int32)
                edges = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(edges, c)], names=["r", "c"])

    return texts.mapInArrow(run, "r bigint, c array<int>")


def score(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the
    model's. Null or empty texts have the end as their only token; repeated
    rows count as often as they stand in training and are scored alike;
    without any training token both scores use no counts; other columns are
    ignored. Counts of words beyond the broadcast ones meet their texts in a
    join, so no word is left out.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(key).cast("bigint").alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(text)).alias("th"))
    counts = cut(word_counts(docs.where(~held_out(F.col(key))).select(F.col(text).cast("string").alias("text"))))
    model = fit(docs, counts, key=key, text=text)
    head = frequent(counts, HEAD).toArrow()
    h, c = head.column("h").to_numpy(), head.column("c").to_numpy().astype(np.float64)
    if model:
        # Words with a leaf are always among those whose counts are broadcast.
        h, c = np.concatenate((h, model.words)), np.concatenate((c, model.amount))
    h, first = np.unique(h, return_index=True)
    held = sc.broadcast((model, h, c[first]))
    schema = "doc_id bigint, held_out boolean, th bigint, n_tokens bigint, n_known bigint, logs double, share_logs double, leaf_logs double, n_rare bigint, rare array<bigint>, times array<int>"

    def run(batches):
        m, words, amount = held.value
        for batch in batches:
            for a, b, h, row in tokens(batch.column("text")):
                n = b - a
                at = np.minimum(np.searchsorted(words, h), len(words) - 1) if len(words) else np.zeros(len(h), np.int64)
                common = words[at] == h if len(words) else np.zeros(len(h), bool)
                logs = np.where(common, np.log10((amount[at] if len(words) else 0.0) + 0.5), 0.0)
                shared, told = common, np.zeros(len(h))
                if m:
                    leaves, norm = m.leaves(h)
                    shared, told = common & ~m.own(h), (m.log_probability(leaves, row) - norm) / np.log(10)
                rare, rare_row = h[~common], row[~common]
                order = np.lexsort((rare, rare_row))
                rare, rare_row = rare[order], rare_row[order]
                new = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (rare_row[1:] != rare_row[:-1]))))[: len(rare)] if len(rare) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate((new, [len(rare)]))).astype(np.int32)
                edges = np.searchsorted(rare_row[new], np.arange(n + 1)).astype(np.int32)
                whole = lambda x, w=None: np.bincount(row[x], None if w is None else w[x], n)
                every = np.ones(len(h), bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, n) for i in (0, 1, 2)),
                        pa.array(whole(every).astype(np.int64)), pa.array(whole(common).astype(np.int64)), pa.array(whole(common, logs).astype(float)),
                        pa.array(whole(shared, logs).astype(float)), pa.array(whole(every, told).astype(float)), pa.array(whole(~common).astype(np.int64)),
                        pa.ListArray.from_arrays(edges, rare[new]), pa.ListArray.from_arrays(edges, times),
                    ],
                    names=["doc_id", "held_out", "th", "n_tokens", "n_known", "logs", "share_logs", "leaf_logs", "n_rare", "rare", "times"],
                )

    rows = cut(src.select("doc_id", "held_out", "th", "text").mapInArrow(run, schema))
    pairs = rows.where(F.size("rare") > 0).select("doc_id", "th", F.explode(F.arrays_zip(F.col("rare"), F.col("times"))).alias("z")).select("doc_id", "th", F.col("z.rare").alias("h"), F.col("z.times").alias("n"))
    # Repeated rows bring their words once; dealing by the word serves both this and the join.
    pairs = pairs.repartition("h").dropDuplicates(["h", "doc_id", "th"])
    met = pairs.join(counts, "h", "left").groupBy("doc_id", "th").agg(
        F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("rare_logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known")
    )
    joined = rows.drop("rare", "times").alias("r").join(met.alias("m"), F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & F.col("r.th").eqNullSafe(F.col("m.th")), "left")
    n, v = (model.tokens, model.distinct) if model else (0, 0)
    base = F.log10(F.lit(n + 0.5 * (v + 1)))
    rare_logs = F.coalesce("m.rare_logs", F.lit(0.0))
    base_score = F.col("r.logs") + rare_logs - F.col("r.n_tokens") * base
    told = F.col("r.leaf_logs") + F.col("r.share_logs") + rare_logs if model else base_score
    return joined.select(
        "r.doc_id", "r.held_out", "r.n_tokens", (F.col("r.n_known") + F.coalesce("m.rare_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"), base_score.alias("base_score"), told.alias("score"),
    )


def base_digest(scored: DataFrame) -> DataFrame:
    """What of :func:`score` SQL can tell: the fold, the counts and the smoothed unigram score, in millionths."""
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


#: The checksum is worked out bit by bit, as DuckDB has none; a space stands for the end, which no word can be.
BASE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 5 = 1 AS held_out,
    list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS w
  FROM documents
), tok AS (SELECT r, held_out, unnest(w) AS t FROM doc),
counts AS (SELECT t, count(*) AS c FROM tok WHERE NOT held_out GROUP BY t),
total AS (SELECT coalesce(CAST(sum(c) AS BIGINT), 0) AS n, count(*) AS v FROM counts),
scored AS (
  SELECT r, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 6) AS base_score
  FROM tok LEFT JOIN counts USING (t) CROSS JOIN total GROUP BY r
)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, base_score FROM doc JOIN scored USING (r)
"""
