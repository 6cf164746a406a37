"""MinHash near-dedup as a chosen-path set similarity join.

Documents with equal shingle sets form classes, and each class is joined once.
Independent trees branch the classes by selected minwise tokens: a node that
is small is compared exhaustively there by its signatures, a larger one
branches by one more token, and a node that stays large to the last level (a
large group of near copies) is kept whole. Trees repeat until a pair at the
threshold is met with the wanted probability. What signatures can't rule out
is confirmed on the full shingle sets, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import cut
from .graph import components

SHINGLE = 5
#: Links: 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
#: Minwise tokens of a signature, and the tokens that a node has fixed at each level of a tree.
TOKENS, LEVELS = 96, (2, 3, 4)
#: Chance to miss a pair at the threshold in all trees.
MISS = 1e-4
#: Documents that a node may have to be compared exhaustively by signature.
SMALL = 64
#: Standard deviations of the signature's estimate that the threshold is lowered by before exact confirmation.
MARGIN = 4.0
#: Documents and shingles of a block in the exact comparison.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 4_000_000
#: Ids up to which they are broadcast to the texts; more of them meet the texts in a shuffle.
BROADCAST_IDS = 500_000


def tree_count(threshold: int = THRESHOLD, miss: float = MISS) -> int:
    """Trees until a pair at the threshold shares a node of the deepest level, but for ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (threshold / 100) ** LEVELS[-1]))


def doc_shingles(column: pa.Array, k: int = SHINGLE):
    """(rows from, to, shingle hashes, offsets) of passes over a batch of texts."""
    data, offsets = K.text_bytes(column)
    for a, b in K.passes(offsets):
        local, here = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, row = K.word_spans(local, here, K.NOT_SPACE)
        yield a, b, *K.shingles(K.word_hashes(local, starts, ends), row, b - a, k)


def _sketches(k: int):
    """Set size, two hashes of the set and the signature of each text (second column), beside the other columns."""

    def run(batches):
        for batch in batches:
            for a, b, h, offsets in doc_shingles(batch.column(1), k):
                sig = K.signatures(h, offsets, TOKENS)
                s0, s1 = K.set_sums(h, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(offsets)), pa.array((s0 ^ K.mix64(s1)).view(np.int64)), pa.array([x.tobytes() for x in sig], pa.binary())],
                    names=["doc_id", "same", "n_shingles", "v", "sig"],
                )

    return run


def _paths(trees: int):
    """The nodes that each class reaches, one row a tree: at every level, the hash of the tokens chosen so far."""
    rng = np.random.default_rng(7)
    chosen = np.array([rng.choice(TOKENS, LEVELS[-1], replace=False) for _ in range(trees)])

    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS)
            for t in range(trees):
                path, keys = np.full(len(sig), K.U(t + 1)), []
                for d, token in enumerate(chosen[t], 1):
                    path = K.mix64(path * K._ODD + sig[:, token].astype(K.U) + K.U(int(token) << 32))
                    if d in LEVELS:
                        keys.append(pa.array(path.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *keys], names=["doc", *(f"k{d}" for d in LEVELS)])

    return run


def _node_pairs(least: float):
    """Pairs that span what a node's documents with signatures that agree often enough connect; rows arrive sorted by node and document."""

    def run(batches):
        tail = None
        for batch in batches:
            node = batch.column(0).to_numpy()
            doc = batch.column(1).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, TOKENS)
            if tail is not None:
                node, doc, sig = np.concatenate((tail[0], node)), np.concatenate((tail[1], doc)), np.concatenate((tail[2], sig))
            last = int(np.searchsorted(node, node[-1])) if len(node) else 0
            yield from _pairs(node[:last], doc[:last], sig[:last], least)
            tail = node[last:], doc[last:], sig[last:]
        if tail is not None:
            yield from _pairs(*tail, least)

    return run


def _pairs(node, doc, sig, least):
    """Pairs that span what the agreeing pairs of each node connect, one to a document at most.

    Only what is connected counts for the coarse components; all pairs of a
    group of near copies would be 32 rows a document from each tree.
    """
    label = np.arange(len(node))
    for step in range(1, SMALL + 1):
        at = np.flatnonzero(node[step:] == node[:-step]) if step < len(node) else ()
        if not len(at):
            break
        # Those that are connected already needn't be compared.
        at = at[label[at] != label[at + step]]
        for low in range(0, len(at), 50_000):
            x = at[low : low + 50_000]
            x = x[(sig[x] == sig[x + step]).mean(axis=1) >= least]
            label = _merged(label, x, x + step)
    if len(x := np.flatnonzero(label != np.arange(len(label)))):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[x], doc[label[x]])), pa.array(np.maximum(doc[x], doc[label[x]]))], names=["a", "b"])


def _merged(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (the first place of each component) after the places x and y are linked."""
    while len(x):
        a, b = label[x], label[y]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    return label


class Forest:
    """Union-find over 0..n-1 that reports the links that joined something."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def exact_links(h: np.ndarray, offsets: np.ndarray, threshold: int, side: np.ndarray | None = None, near=()) -> list[tuple[int, int]]:
    """Links that span the components of a block, from full sets; every pair of the block is judged.

    With ``side`` only links between two sides are given, those within one are
    told elsewhere; the documents ``near`` are known to be connected.

    Intersections come from products of 0/1 matrices over slices of the
    block's vocabulary, so no pair of sets is merged by itself.
    """
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    words, column, df = np.unique(h, return_inverse=True, return_counts=True)
    shared = df > 1
    number = np.cumsum(shared) - 1
    both = np.zeros((n, n))
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = max(256, (4 << 20) // max(1, n))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    x, y = np.nonzero(np.triu((100 * both >= threshold * union) & (both > 0), 1))
    forest = Forest(n)
    for a, b in zip(near, near[1:]):  # noqa: RUF007
        forest.join(a, b)
    if side is not None:
        within = side[x] == side[y]
        for a, b in zip(x[within].tolist(), y[within].tolist(), strict=True):
            forest.join(a, b)
        x, y = x[~within], y[~within]
    return [(a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True) if forest.join(a, b)]


def hub_links(h: np.ndarray, offsets: np.ndarray, threshold: int, hub: int) -> list[tuple[int, int]]:
    """Links of one set of a block with the others, from full sets."""
    sizes = np.diff(offsets)
    mine = h[offsets[hub] : offsets[hub + 1]]
    at = np.minimum(np.searchsorted(mine, h), len(mine) - 1)
    both = np.bincount(np.repeat(np.arange(len(sizes)), sizes), mine[at] == h, len(sizes)).astype(np.int64)
    near = (100 * both >= threshold * (sizes + len(mine) - both)) & (both > 0)
    return [(min(x, hub), max(x, hub)) for x in np.flatnonzero(near).tolist() if x != hub]


def _confirm(threshold: int, k: int, hubs: bool = False):
    """Links within each task's documents; with ``hubs`` those of the document that the task's rows name as theirs.

    Without, a document whose row names a hub is connected with it already, and
    the hub stands for it; documents of two sides give links across alone.
    """

    def links(rows):
        parts, ends, docs, whose = [], [0], [], []
        names = [r[0] for r in rows]
        for a, b, h, offsets in doc_shingles(pa.array([r[1] for r in rows], pa.string()), k):
            s0, s1 = K.set_sums(h, offsets)
            sums = (s0 ^ K.mix64(s1)).view(np.int64)
            for r in range(b - a):
                if int(sums[r]) == names[a + r] and (not docs or docs[-1] != names[a + r]):
                    docs.append(names[a + r])
                    whose.append(rows[a + r])
                    parts.append(h[offsets[r] : offsets[r + 1]])
                    ends.append(ends[-1] + len(parts[-1]))
        if len(docs) < 2:
            return []
        h, ends = np.concatenate(parts), np.array(ends)
        if hubs:
            return [(docs[a], docs[b]) for a, b in hub_links(h, ends, threshold, docs.index(rows[0][2]))]
        side, near = np.array([r[3] for r in whose]), [i for i, r in enumerate(whose) if r[2] is not None]
        told = [doc if r[2] is None else r[2] for doc, r in zip(docs, whose, strict=True)]
        found = exact_links(h, ends, threshold, side if side.min() < side.max() else None, near)
        return [(min(told[a], told[b]), max(told[a], told[b])) for a, b in found]

    def batch_of(pairs):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.int64())], names=["a", "b"])

    def run(batches):
        now, rows = None, []
        for batch in batches:
            out = []
            for key, doc, text, hub, side in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if key != now:
                    out.extend(links(rows) if len(rows) > 1 else ())
                    now, rows = key, []
                rows.append((doc, text, hub, side))
            yield batch_of(out)
        yield batch_of(links(rows) if len(rows) > 1 else [])

    return run


def candidates(reps: DataFrame, threshold: int, trees: int) -> DataFrame:
    """Candidate links (a, b) between classes from all trees, as many as connect what all candidates would.

    Small nodes give links that span the pairs which their signatures leave possible; a node
    that is still large at the last level gives a link from each document to
    its least one, whatever the signatures say, so that it stays together.
    """
    t = threshold / 100
    least = t - MARGIN * math.sqrt(t * (1 - t) / TOKENS)
    names = [f"k{d}" for d in LEVELS]
    rest = reps.select("v", "sig").mapInArrow(_paths(trees), "doc bigint, " + ", ".join(f"{n} bigint" for n in names))
    small, links = [], []
    for i, level in enumerate(names):
        size = rest.groupBy(level).agg(F.count("*").alias("n"), F.min("doc").alias("least")).where("n > 1")
        there = rest.join(size, level)
        small.append(there.where(F.col("n") <= SMALL).select(F.col(level).alias("node"), "doc"))
        if i + 1 == len(names):
            links.append(there.where((F.col("n") > SMALL) & (F.col("doc") != F.col("least"))).select(F.col("least").alias("a"), F.col("doc").alias("b")))
        else:
            rest = cut(there.where(F.col("n") > SMALL).select(*names[i + 1 :], "doc"))
    nodes = small[0]
    for x in small[1:]:
        nodes = nodes.unionByName(x)
    signed = nodes.join(reps.select(F.col("v").alias("doc"), "sig"), "doc").select("node", "doc", "sig")
    pairs = signed.repartition("node").sortWithinPartitions("node", "doc").mapInArrow(_node_pairs(least), "a bigint, b bigint")
    return pairs.unionByName(links[0]).distinct()


def _blocked(sized: DataFrame) -> DataFrame:
    """v, rep, label, blocks, mine: the documents of each label dealt to blocks of bounded size."""
    blocks = sized.groupBy("label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")).select(
        "label", F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    return sized.join(blocks, "label").select("v", "rep", "label", "n_shingles", "blocks", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("mine"))


def _confirmed(sized: DataFrame, texts: DataFrame, threshold: int, k: int) -> DataFrame:
    """Links (a, b) within coarse components that span what full sets connect.

    A component of one block is compared as a whole. In a larger one all
    documents are compared with its least first; those that it links are
    connected already, so that only pairs with one of the rest are left: in
    a group of copies of one text these are few, and the work grows with the
    group and not with its square. Links within a block are told by the task
    that has the block alone; a link with a document that the least one links
    is told as one with the least, so that it is told once.
    """
    none = F.lit(None).cast("bigint").alias("hub")

    def compared(tasks: DataFrame, hubs: bool = False) -> DataFrame:
        work = tasks.join(texts, F.col("rep") == F.col("doc_id")).select("task", "v", "text", "hub", "side").repartition("task").sortWithinPartitions("task", "v")
        return work.mapInArrow(_confirm(threshold, k, hubs), "a bigint, b bigint")

    placed = cut(_blocked(sized))
    whole = placed.where("blocks = 1").select("v", "rep", F.xxhash64("label").alias("task"), none, F.lit(0).alias("side"))
    large = placed.where("blocks > 1")
    hub = F.col("label").alias("hub")
    others = large.where("v <> label").select("v", "rep", F.xxhash64("label", "mine").alias("task"), hub, F.lit(0).alias("side"))
    first = large.where("v = label").select("v", "rep", "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine")).select("v", "rep", F.xxhash64("label", "mine").alias("task"), hub, F.lit(0).alias("side"))
    starred = cut(compared(others.unionByName(first), hubs=True))
    joined = starred.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("near", F.lit(True))
    told = large.select("v", "rep", "label", "n_shingles").join(joined, "v", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    # The hub counts as joined to itself.
    told = cut(told.withColumn("near", F.col("near") | (F.col("v") == F.col("label"))))
    rest = _blocked(told.where("not near").select("v", "rep", "label", "n_shingles"))
    sizes = rest.select("label", "blocks").distinct()
    near = _blocked(told.where("near").select("v", "rep", "label", "n_shingles")).join(sizes.withColumnRenamed("blocks", "rests"), "label")
    nears = near.select("label", F.col("blocks").alias("nears")).distinct()
    range_ = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = rest.select("v", "rep", "label", "mine", F.explode(range_("blocks")).alias("other")).select("v", "rep", F.xxhash64("label", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"), none, F.col("mine").alias("side"))
    across = rest.join(nears, "label").select("v", "rep", "label", "mine", F.explode(range_("nears")).alias("other")).select("v", "rep", F.xxhash64("label", "mine", "other", F.lit("near")).alias("task"), none, F.lit(0).alias("side"))
    met = near.select("v", "rep", "label", "mine", F.explode(range_("rests")).alias("other")).select("v", "rep", F.xxhash64("label", "other", "mine", F.lit("near")).alias("task"), hub, F.lit(1).alias("side"))
    return compared(whole.unionByName(own).unionByName(across).unionByName(met)).distinct().unionByName(starred)


def grouped(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = SHINGLE, threshold: int = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, same (the text's hash), n_shingles, label (the group's; null without one), component.

    Rows are linked by their texts: equal shingle sets always, others if the
    sets pass the threshold. Null and wordless texts link with nothing. Rows
    that repeat an id stand for themselves by their text; a row with a null id
    is outside of the join and a component of its own (component_id null, kept
    true). Other columns are ignored.
    """
    src = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("same", F.xxhash64("text"))
    rows = cut(src.mapInArrow(_sketches(k), "doc_id bigint, same bigint, n_shingles bigint, v bigint, sig binary"))
    live = rows.where("n_shingles > 0 and doc_id is not null")
    reps = cut(live.groupBy("v").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "sig"), "doc_id").alias("s")).select("v", "rep", "s.*"))
    coarse = components(candidates(reps, threshold, tree_count(threshold, miss)))
    # Rows that repeat an id bring several texts; the confirmation takes the one whose set is the class's.
    sized = cut(coarse.join(reps.select("v", "rep", "n_shingles"), "v"))
    wanted = sized.select("rep")
    wanted = F.broadcast(wanted) if sized.count() <= BROADCAST_IDS else wanted
    texts = cut(src.join(wanted, F.col("doc_id") == F.col("rep"), "left_semi").dropDuplicates(["doc_id", "same"]))
    found = components(cut(_confirmed(sized, texts, threshold, k)))
    groups = cut(reps.join(found, "v", "left").select("v", "rep", F.coalesce("label", "v").alias("label")))
    least = groups.groupBy("label").agg(F.min("rep").alias("component"))
    names_of = groups.join(least, "label").select("v", "label", "component")
    out = rows.select("doc_id", "same", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("v")).alias("v"))
    # Texts without words have no class and stay out of the join.
    none = F.lit(None).cast("bigint")
    alone = out.where("v is null").select("doc_id", "same", "n_shingles", none.alias("label"), none.alias("component"))
    return out.where("v is not null").join(names_of, "v", "left").select("doc_id", "same", "n_shingles", "label", "component").unionByName(alone)


def link(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept; options and cases as of :func:`grouped`."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = grouped(docs, **options).select("doc_id", "n_shingles", component.alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near copies, with all columns of ``docs``.

    The row of the least id stays, of versions that share an id the one whose
    text's hash is least, whatever other groups these ids are in; rows without
    an id come last, in order of their texts' hashes, and go like others. Rows
    that repeat an id and a text stay once. Null and wordless texts are in no
    group and stay.
    """
    # Rows without an id are told apart by their texts, behind all ids that are in use.
    id_ = F.coalesce(F.col(key).cast("bigint"), F.lit(1 << 62) + F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(1 << 61)))
    keyed = docs.withColumn("id_", id_).withColumn("same_", F.xxhash64(F.col(text).cast("string")))
    rows = cut(grouped(keyed, key="id_", text=text, **options).select(F.col("doc_id").alias("id_"), F.col("same").alias("same_"), "label"))
    first = rows.where("label is not null").groupBy("label").agg(F.min(F.struct("id_", "same_")).alias("f")).select("f.*")
    kept = first.unionByName(rows.where("label is null").select("id_", "same_")).distinct()
    times = rows.groupBy("id_", "same_").agg((F.count("*") > 1).alias("again_"))
    kept = cut(times.join(kept, ["id_", "same_"]))
    if kept.count() > BROADCAST_IDS:
        # The join and the removal of repeated rows share one dealing by id.
        return keyed.join(kept, ["id_", "same_"], "left_semi").dropDuplicates(["id_", "same_"]).select(*docs.columns)
    there = keyed.join(F.broadcast(kept), ["id_", "same_"])
    # Only rows that repeat are dealt anew.
    return there.where("not again_").unionByName(there.where("again_").dropDuplicates(["id_", "same_"])).select(*docs.columns)


LINK_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(w[i : i + 4]) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, CAST(len(w) AS BIGINT) - 3))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * s.n >= 85 * (a.n + b.n - s.n)),
reach AS (SELECT doc_id, doc_id AS c FROM words UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.doc_id),
least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept FROM words w JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
