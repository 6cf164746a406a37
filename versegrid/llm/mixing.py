"""Mixing sources to target weights with hash-threshold histograms (native).

Every row has a stable 60-bit hash of its id, source and text. Words are summed by source and hash
bucket, cumulative sums locate the bucket in which a source's budget runs
out, and only the rows of that boundary bucket are summed again by the next
12 bits of their hash. After five rounds the threshold is exact to one hash
value, and a plain filter applies it: nothing is sorted by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, row_key

#: Words of a text: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a row's hash, and bits that one round of refinement looks at.
HASH_BITS, ROUND_BITS = 60, 12
#: A row is taken at most so often.
MOST_COPIES = 3
#: Sources up to which a row for each is broadcast, and salts that split a source's rows beyond that.
FEW_SOURCES, SALTS = 10_000, 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """Targets for (source, source_size) rows, one row for each source.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    the sum of all sizes; a target stops at ``most`` times its source's size
    and the excess is shared by weight among the rest until none is above.

    With sources ordered by size/weight, those that hit the cap are a prefix;
    after k capped sources the others get (total - most*capped size) * weight /
    (weight left), and k is the least one at which the next source fits.
    The windows run over one pre-aggregated row a source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("weight", w.cast("bigint"))
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    t = (
        t.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("capped_size", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("capped_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("pool", F.col("total") - most * F.col("capped_size"))
        .withColumn("left", F.col("weights") - F.col("capped_weight"))
        .withColumn("fits", F.col("pool") * F.col("weight") <= most * F.col("source_size") * F.col("left"))
        .withColumn("level", F.row_number().over(by_ratio))
    )
    first = F.min(F.when(F.col("fits"), F.col("level"))).over(whole)
    t = t.withColumn("first_fit", first)
    pool = F.max(F.when(F.col("level") == F.col("first_fit"), F.col("pool"))).over(whole)
    left = F.max(F.when(F.col("level") == F.col("first_fit"), F.col("left"))).over(whole)
    capped = F.coalesce(F.col("level") < F.col("first_fit"), F.lit(True))
    t = t.withColumn("share", F.when(capped, None).otherwise(pool)).withColumn("parts", F.when(capped, None).otherwise(left))
    size, share, parts = F.col("source_size"), F.col("share") * F.col("weight"), F.col("parts")
    whole_copies = F.when(capped, F.lit(most)).when(size == 0, F.lit(0)).otherwise(F.floor(F.expr("(share * weight) div (parts * source_size)")))
    budget = F.when(capped | (size == 0), F.lit(0)).otherwise(F.expr("(share * weight) div parts") - whole_copies * size)
    return t.select(
        "source", "source_size", "weight",
        F.when(capped, (most * size).cast("double")).otherwise(share.cast("double") / parts.cast("double")).alias("target"),
        whole_copies.cast("bigint").alias("copies"),
        budget.cast("bigint").alias("budget"),
    )


def attach(rows: DataFrame, few: DataFrame, bounded: bool) -> DataFrame:
    """Each row (alias r) with its source's row of ``few`` (alias s).

    ``bounded`` says that ``few`` was counted and is small: it is broadcast.
    Otherwise both sides are dealt by source and salt, so no task gets a whole source.
    """
    same = F.col("r.source").eqNullSafe(F.col("s.source"))
    if bounded:
        return rows.alias("r").join(F.broadcast(few.alias("s")), same)
    salted = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int")).alias("r").join(salted.alias("s"), same & (F.col("r.salt") == F.col("s.salt")))


def hash_thresholds(rows: DataFrame, budgets: DataFrame, bounded: bool) -> DataFrame:
    """(source, threshold): rows whose ``h`` is below it hold the budget's words.

    ``rows`` has source, size and h; ``budgets`` source and budget. The sum of
    the rows below a threshold comes as near to the budget as whole hash values
    let it: the value that straddles the budget is in if that errs less.
    """
    state = budgets.select("source", F.lit(0).cast("bigint").alias("prefix"), F.col("budget").alias("left"))
    for shift in range(HASH_BITS - ROUND_BITS, -1, -ROUND_BITS):
        inside = attach(rows, state, bounded).where(F.shiftright(F.col("r.h"), shift + ROUND_BITS) == F.col("s.prefix"))
        histogram = inside.groupBy(
            F.col("s.source").alias("source"), F.col("s.left").alias("left"), F.shiftright(F.col("r.h"), shift).alias("prefix")
        ).agg(F.sum("r.size").alias("words"))
        upto = Window.partitionBy("source").orderBy("prefix")
        rest = Window.partitionBy("source")
        cum = histogram.withColumn("cum", F.sum("words").over(upto)).withColumn("start", F.col("cum") - F.col("words"))
        # The boundary: the first bucket that goes beyond what is left, else the last one.
        cum = cum.withColumn("beyond", F.min(F.when(F.col("cum") > F.col("left"), F.col("prefix"))).over(rest)).withColumn("last", F.max("prefix").over(rest))
        cum = cum.where(F.col("prefix") == F.coalesce("beyond", "last"))
        if shift:
            state = cum.select("source", "prefix", (F.col("left") - F.col("start")).alias("left"))
        else:
            over, under = F.col("cum") - F.col("left"), F.col("left") - F.col("start")
            take = F.col("beyond").isNull() | (over < under)
            state = cum.select("source", (F.col("prefix") + F.when(take, 1).otherwise(0)).alias("threshold"))
    return state


def sized(docs: DataFrame, carry: tuple[str, ...], key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """source, size and h of each row, and the carried columns. Rows that share an id but not the text have hashes of their own."""
    told = row_key(F.col(key), F.col(source), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    return docs.select(F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), told.alias("h"), *[F.col(c).alias(f"carry_{c}") for c in carry])


def equals(rows: DataFrame) -> DataFrame | None:
    """The hashes that several rows share: rows equal in id, source and text. None where there are none."""
    again = cut(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    return again if again.limit(1).count() else None


def apart(rows: DataFrame, again: DataFrame | None) -> DataFrame:
    """``rows``, equal ones with hashes by their rank, so that a mix may take some of them; which of them is the same."""
    if again is None:
        return rows
    ranked = rows.join(again, "h", "left_semi").withColumn("rank_", F.row_number().over(Window.partitionBy("h").orderBy("size")))
    ranked = ranked.withColumn("h", F.when(F.col("rank_") > 1, row_key(F.col("h"), F.col("rank_"))).otherwise(F.col("h"))).drop("rank_")
    return rows.join(again, "h", "left_anti").unionByName(ranked)


def plan(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> tuple[DataFrame, bool]:
    """source, source_size, target, copies and threshold of each source; whether the sources are few."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(totals, weights, most))
    bounded = targets.count() <= FEW_SOURCES
    bounds = hash_thresholds(rows, targets.where(F.col("budget") > 0), bounded)
    joined = targets.alias("t").join(bounds.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")), "left")
    return cut(joined.select("t.*", F.coalesce("b.threshold", F.lit(0)).alias("threshold"))), bounded


def take(rows: DataFrame, planned: DataFrame, bounded: bool, carry: tuple[str, ...]) -> DataFrame:
    copies = (F.col("s.copies") + F.when(F.col("r.h") < F.col("s.threshold"), 1).otherwise(0)).cast("bigint")
    return attach(rows, planned, bounded).select(*[F.col(f"r.carry_{c}").alias(c) for c in carry], "r.size", "s.source_size", "s.target", (copies * F.col("r.size")).alias("taken"), copies.alias("copies"))


def mix(docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id", "source"), key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """The ``carry`` columns of each row and size, source_size, target, taken, copies.

    ``copies`` is how often the mix takes the row and ``taken`` its words,
    copies counted. Each row gets the whole copies that its source's target
    allows, and rows below the hash threshold get one more. Only sizes and
    hashes are kept between the rounds; carried columns are read at the end.

    Defined cases: a null text has size 0; null sources form one source, the
    last; rows that share a key (a null one counts as the empty string) are
    rows of their own, and of rows equal in key, source and text some may be
    taken more often than others (such a group is ranked in one task); a table
    without words takes nothing; an empty table gives an empty result; other
    columns are ignored.
    """
    narrow = cut(sized(docs, (), key, text, source))
    again = equals(narrow)
    planned, bounded = plan(apart(narrow, again), weights, most)
    return take(apart(sized(docs, carry, key, text, source), again), planned, bounded, carry)


MIX_SQL = r"""
WITH hashed AS (
  SELECT doc_id, CAST(source AS VARCHAR) AS source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(CAST(source AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15)) AS BIGINT) AS h0
  FROM documents
), sized AS (
  SELECT doc_id, source, size, CASE WHEN k > 1 THEN CAST(('0x' || substr(md5(h0 || '|' || k), 1, 15)) AS BIGINT) ELSE h0 END AS h FROM (SELECT *, row_number() OVER (PARTITION BY h0) AS k FROM hashed)
), totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, (row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
ordered AS (
  SELECT *, row_number() OVER w AS level,
         CAST(sum(source_size) OVER () AS BIGINT) - 3 * coalesce(CAST(sum(source_size) OVER b AS BIGINT), 0) AS pool,
         CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER b AS BIGINT), 0) AS parts
  FROM weighted
  WINDOW w AS (ORDER BY source_size / weight, encode(source) ASC NULLS LAST),
         b AS (ORDER BY source_size / weight, encode(source) ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fit AS (SELECT min(level) AS level FROM ordered WHERE pool * weight <= 3 * source_size * parts),
targets AS (
  SELECT o.source, o.source_size,
    CASE WHEN f.level IS NULL OR o.level < f.level THEN CAST(3 * o.source_size AS DOUBLE)
         ELSE CAST(g.pool * o.weight AS DOUBLE) / CAST(g.parts AS DOUBLE) END AS target,
    CASE WHEN f.level IS NULL OR o.level < f.level THEN 3 WHEN o.source_size = 0 THEN 0
         ELSE (g.pool * o.weight) // (g.parts * o.source_size) END AS copies,
    CASE WHEN f.level IS NULL OR o.level < f.level OR o.source_size = 0 THEN 0
         ELSE (g.pool * o.weight) // g.parts - ((g.pool * o.weight) // (g.parts * o.source_size)) * o.source_size END AS budget
  FROM ordered o CROSS JOIN fit f LEFT JOIN ordered g ON g.level = f.level
), grouped AS (
  SELECT s.source, s.h, CAST(sum(s.size) AS BIGINT) AS words FROM sized s GROUP BY s.source, s.h
), cumulated AS (
  SELECT g.*, t.budget, CAST(sum(words) OVER (PARTITION BY g.source ORDER BY h) AS BIGINT) AS cum
  FROM grouped g JOIN targets t ON g.source IS NOT DISTINCT FROM t.source
), extra AS (
  SELECT source, h, budget > 0 AND (cum <= budget OR (cum - words <= budget AND cum - budget < budget - (cum - words))) AS more FROM cumulated
)
SELECT s.doc_id, s.size, t.source_size, t.target,
       CAST((t.copies + CASE WHEN e.more THEN 1 ELSE 0 END) * s.size AS BIGINT) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
JOIN extra e ON e.source IS NOT DISTINCT FROM s.source AND e.h = s.h
"""
