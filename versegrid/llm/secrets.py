"""Secret scans with corpus-wide ownership frequency (native).

The base patterns give spans in every text. Beside them, long mixed runs of
letters and digits that no base span covers are candidates: their hashes are
aggregated by distinct repositories and owners over the whole corpus. A hash
that many owners carry is a copied example; one that stays with few owners and
looks random is taken for a live credential, and its spans are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import located, once, unmarked
from .common import cut, merged, sha256_hex, without

#: Fixed patterns. Group 2 of ``assign`` is the value; only its keyword ignores case.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A candidate beyond the base patterns.
CANDIDATE = r"[A-Za-z0-9_-]{20,}"
#: A candidate is live-looking with a digit, both letter cases, and at most so many owners.
MOST_OWNERS = 2
REDACTED = "<SECRET>"


_NONE = "array<struct<start:int,kind:int,end:int,hash:string>>"


def _spans(text: Column, pattern: str, kind: int, groups: int = 0, keep=None) -> Column:
    """Spans of one pattern over an unmarked text, with the hash of each match's last group, or of the whole match without groups."""
    found = located(text, pattern, groups)
    if keep is not None:
        found = F.filter(found, keep)
    whole, value = (lambda m: m["parts"][groups]), (lambda m: m["parts"][max(groups - 1, 0)])
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(whole(m))).alias("end"), F.sha2(value(m).cast("binary"), 256).alias("hash")))


KINDS = ("assign", "access", "hex", "token")


def joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(text: Column) -> Column:
    """Spans of the base patterns in an unmarked text by start, then kind, with the hash of the value that each holds."""
    long_value = lambda m: F.length(m["parts"][1]) >= 8
    return F.array_sort(F.concat(_spans(text, ASSIGN, 0, 2, long_value), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_repos, n_owners from (hash, repo, owner) rows.

    Duplicates are dropped by (hash, repo, owner) first, with map-side combine,
    so a hash that fills a third of the rows reaches the count as one row for
    each of its repositories, and its owners are then counted from partial sums.
    """
    once = candidates.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, *, carry: tuple[str, ...] = ("doc_id",), text: str = "text", repo: str = "doc_id", owner: str = "source", most_owners: int = MOST_OWNERS, narrow: bool = True) -> DataFrame:
    """The ``carry`` columns of each row and base, live, n_live, n_examples.

    ``base`` holds the base patterns' spans as (start, kind, end, hash). ``live``
    holds the spans of further candidates that at most ``most_owners`` owners
    carry anywhere. ``n_live`` and ``n_examples`` count the row's values, base
    ones too, that so few or more owners carry. Null or empty texts have no
    spans; null repositories and owners count as one value each; repeated rows
    give repeated results; other columns are ignored. ``narrow`` says that the
    carried columns are small enough to keep with the spans; otherwise the
    texts are scanned again rather than stored.
    """
    body = unmarked(F.coalesce(F.col(text), F.lit("")))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = docs.select(*[F.col(c).alias(f"carry_{c}") for c in carry], name(repo).alias("repo"), name(owner).alias("owner"), body.alias("body"))
    looks = lambda m: m["parts"][0].rlike("[0-9]") & m["parts"][0].rlike("[A-Z]") & m["parts"][0].rlike("[a-z]")
    kept = [f"carry_{c}" for c in carry] + ["repo", "owner"]
    rows = src.select(*kept, base_spans(F.col("body")).alias("base"), _spans(F.col("body"), CANDIDATE, 3, keep=looks).alias("more"))
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    rows = rows.select(*kept, "base", F.array_sort(F.concat("base", free)).alias("found"))
    if narrow:
        rows = cut(rows)
    some = rows.where(F.size("found") > 0)
    if not narrow:
        some = cut(some.select("repo", "owner", "found"))
    each = some.select("repo", "owner", F.explode("found.hash").alias("hash"))
    # A candidate list identifies its row's candidates whatever repeats the key, so lists are judged once.
    lists = some.select(F.xxhash64("found").alias("list"), "found").groupBy("list").agg(F.first("found").alias("found"))
    few = F.col("n_owners") <= most_owners
    judged = (
        lists.select("list", F.explode("found").alias("c")).select("list", "c.*").join(ownership(each), "hash").groupBy("list").agg(
            F.array_sort(F.collect_list(F.when(few & (F.col("kind") == 3), F.struct("start", "kind", "end", "hash")))).alias("live"),
            F.sum(F.when(few, 1).otherwise(0)).cast("bigint").alias("n_live"),
            F.sum(F.when(few, 0).otherwise(1)).cast("bigint").alias("n_examples"),
        )
    )
    # Most rows hold nothing and take no part in the join.
    zero = lambda c: F.lit(0).cast("bigint").alias(c)
    clean = rows.where(F.size("found") == 0).select(*kept, "base", F.array().cast(_NONE).alias("live"), zero("n_live"), zero("n_examples"))
    with_any = rows.where(F.size("found") > 0).withColumn("list", F.xxhash64("found")).join(judged, "list").select(*kept, "base", "live", "n_live", "n_examples")
    return clean.unionByName(with_any).select(*[F.col(f"carry_{c}").alias(c) for c in carry], "base", "live", "n_live", "n_examples")


def digest(scanned: DataFrame) -> DataFrame:
    """The query's columns from :func:`scan`'s rows."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return scanned.select("doc_id", n(0), n(1), n(2), sha256_hex(joined(F.col("base"))).alias("base_sha256"), joined(F.array_sort(F.concat("base", "live"))).alias("spans"), "n_live", "n_examples")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each maximal covered run replaced by a marker."""

    def run(sorted_: Column) -> Column:
        starts, ends = F.transform(sorted_, lambda s: s["start"]), F.transform(sorted_, lambda s: s["end"])
        return once(starts, lambda a: once(ends, lambda b: once(merged(a, b), lambda r: without(text, r, REDACTED))))

    return F.when(F.size(spans) > 0, once(F.array_sort(spans), run)).otherwise(text)


def _placed_sql(name: str, pattern: str, kind: int, value: str, keep: str) -> str:
    """Matches of one pattern with their places: texts are cut at the matches, and lengths are summed up."""
    p = pattern.replace("'", "''")
    return f"""{name} AS (
  SELECT doc, {kind} AS kind, place AS start, place + length(hit) AS stop, hit, {value.format(p=p)} AS value FROM (
    SELECT doc, hit, CAST(sum(length(gap) + length(coalesce(hit, ''))) OVER (PARTITION BY doc ORDER BY i) - length(coalesce(hit, '')) AS BIGINT) AS place FROM (
      SELECT doc, unnest(regexp_extract_all(body, '{p}')) AS hit, unnest(gaps) AS gap, generate_subscripts(gaps, 1) AS i FROM (
        SELECT doc, body, string_split(regexp_replace(body, '{p}', chr(1), 'g'), chr(1)) AS gaps FROM docs WHERE regexp_matches(body, '{p}'))))
  WHERE hit IS NOT NULL AND {keep})"""


_ASSIGN_SQL = ASSIGN.replace("((?i)password|passwd|secret|token|api_?key)", "(?i:password|passwd|secret|token|api_?key)")
SCAN_SQL = (
    "WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(source, '') AS owner, regexp_replace(coalesce(text, ''), '[\\x01-\\x03]', chr(4), 'g') AS body FROM documents),\n"
    + ",\n".join([
        _placed_sql("assigned", _ASSIGN_SQL, 0, "regexp_extract(hit, '{p}', 1)", "length(value) >= 8"), _placed_sql("access", ACCESS, 1, "hit", "TRUE"), _placed_sql("hexed", HEX, 2, "hit", "TRUE"),
        _placed_sql("runs", CANDIDATE, 3, "hit", "regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')"),
    ])
    + f""", base AS (SELECT * FROM assigned UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hexed),
found AS (SELECT * FROM base UNION ALL SELECT * FROM runs r WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc = r.doc AND b.start < r.stop AND r.start < b.stop)),
owned AS (SELECT value, count(DISTINCT owner) AS owners FROM found JOIN docs USING (doc) GROUP BY value),
told AS (
  SELECT doc, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(n || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    string_agg(n || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (kind < 3 OR owners <= {MOST_OWNERS}) AS spans,
    count(*) FILTER (owners <= {MOST_OWNERS}) AS n_live, count(*) FILTER (owners > {MOST_OWNERS}) AS n_examples
  FROM (SELECT *, (['assign', 'access', 'hex', 'token'])[kind + 1] AS n FROM found JOIN owned USING (value)) GROUP BY doc
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples
FROM docs LEFT JOIN told USING (doc)"""
)
