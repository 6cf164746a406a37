"""Annotated XML: clean text with annotation offsets, and metadata, from possibly broken markup."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import creator

# Elements whose content is no running text, and dates that beat others.
SKIPPED = frozenset(("ThML.head", "head", "note", "scripCom", "index", "pb", "milestone"))
FIRST_DATES = ("published", "original", "written", "composed")

_NODE = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<\?(?P<pi>.*?)(?:\?>|\Z)|<!(?:[^<>\[]|\[.*?\])*>"
    r"|</(?P<end>[^\s>]+)\s*>|<(?P<start>[A-Za-z_][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_ENTITY = re.compile(r"&(?:#(\d+)|#[xX]([0-9a-fA-F]+)|(amp|lt|gt|quot|apos));")
_BASIC = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _decode(text: str) -> str:
    """Numeric and predefined references; others stay as written."""
    return _ENTITY.sub(lambda m: chr(int(m[1])) if m[1] else chr(int(m[2], 16)) if m[2] else _BASIC[m[3]], text)


def events(xml: str) -> Iterator[tuple[str, str, dict]]:
    """("text" | "other" | "start" | "end", name or text, attributes); empty elements end at once."""
    at = 0
    for m in _NODE.finditer(xml):
        if m.start() > at:
            yield "text", _decode(xml[at : m.start()]), {}
        at = m.end()
        if m["start"]:
            raw, name = m["attrs"], m["start"].rpartition(":")[2]
            yield "start", name, {k: _decode(a or b) for k, a, b in _ATTRIBUTE.findall(raw)}
            if raw.rstrip().endswith("/"):
                yield "end", name, {}
        elif m["end"]:
            yield "end", m["end"].rpartition(":")[2], {}
        elif m["cdata"] is not None:
            yield "text", m["cdata"], {}
        elif m["comment"] is not None:
            yield "other", m["comment"], {}
        elif m["pi"] is not None and not m["pi"].startswith("xml "):
            yield "other", m["pi"].partition(" ")[2], {}
    if at < len(xml):
        yield "text", _decode(xml[at:]), {}


def walk(xml: str) -> dict:
    """clean_text, hits (parsed attribute and offset of each annotation), and first texts of metadata elements.

    Text under a skipped element goes, what follows it stays. Comments and
    processing instructions within the root count as text.
    """
    out: list[str] = []
    size, depth_skipped, stack = 0, 0, []
    hits, first, dates = [], {}, []
    pending: tuple[str, str] | None = None
    for kind, value, attributes in events(xml):
        if kind == "start":
            pending = (value, attributes.get("sub", "").lower())
            stack.append(value)
            depth_skipped += value in SKIPPED
            if value == "scripRef" and not depth_skipped:
                hits.append((attributes.get("parsed"), size))
            continue
        if kind == "end":
            pending = None
            if value in stack:
                while True:
                    name = stack.pop()
                    depth_skipped -= name in SKIPPED
                    if name == value:
                        break
            continue
        if pending and kind == "text" and value:
            if pending[0] == "DC.Date":
                dates.append((pending[1], value))
            first.setdefault(pending[0], value.strip())
        pending = None
        if stack and not depth_skipped:
            out.append(value)
            size += len(value)
    return {"clean_text": "".join(out), "hits": hits, "title": first.get("DC.Title"), "creator": first.get("DC.Creator"), "author_id": first.get("authorID"), "book_id": first.get("bookID"), "dates": dates}


WALKED = "path string, clean_text string, hits array<struct<parsed:string,citation_offset:int>>, title string, creator string, author_id string, book_id string, dates array<struct<sub:string,text:string>>"
_WALKED = pa.schema([
    ("path", pa.string()), ("clean_text", pa.string()), ("hits", pa.list_(pa.struct([("parsed", pa.string()), ("citation_offset", pa.int32())]))), ("title", pa.string()),
    ("creator", pa.string()), ("author_id", pa.string()), ("book_id", pa.string()), ("dates", pa.list_(pa.struct([("sub", pa.string()), ("text", pa.string())]))),
])


def walk_function():
    """:func:`walk` as a function of a column of XML texts, for SQL."""
    names = [f.name for f in _WALKED if f.name != "path"]

    @F.pandas_udf(WALKED.removeprefix("path string, "))
    def walked(contents: pd.Series) -> pd.DataFrame:
        rows = [walk(x or "") for x in contents]
        return pd.DataFrame({n: [r[n] for r in rows] for n in names})

    return walked


HIT = "parsed string, citation_offset int"


def hits_function():
    """The annotations that :func:`walk` meets in each of a column's XML texts, as arrays that come back as columns, a batch at a time."""

    @F.arrow_udf(f"array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>")
    def hits(contents: pa.Array) -> pa.Array:
        ends, parsed, places = [0], [], []
        for content in contents.to_pylist():
            for said, at in walk(content)["hits"] if content else ():
                parsed.append(said)
                places.append(at)
            ends.append(len(parsed))
        rows = pa.StructArray.from_arrays([pa.array(parsed, pa.string()), pa.array(places, pa.int32())], names=["parsed", "citation_offset"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return hits


def parse(docs: DataFrame, *, path: str = "path", content: str = "content") -> DataFrame:
    """Walks each document (string or binary content) once."""

    def run(batches):
        for batch in batches:
            rows = []
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = walk(raw.decode("utf-8", "replace") if isinstance(raw, bytes) else raw or "")
                got["hits"] = [{"parsed": a, "citation_offset": b} for a, b in got["hits"]]
                got["dates"] = [{"sub": a, "text": b} for a, b in got["dates"]]
                rows.append({"path": p, **got})
            yield pa.RecordBatch.from_pylist(rows, schema=_WALKED)

    return docs.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInArrow(run, WALKED)


def year(dates: Column) -> Column:
    """The first preferred date's year, else the first year that any date gives."""
    dated = F.filter(F.transform(dates, lambda d: F.struct(d["sub"].isin(*FIRST_DATES).alias("best"), F.regexp_extract(d["text"], r"(?U)\b(1\d{3}|[2-9]\d{2})\b", 1).try_cast("int").alias("y"))), lambda d: d["y"].isNotNull())
    best = F.filter(dated, lambda d: d["best"])
    return F.coalesce(F.get(best, F.lit(0))["y"], F.get(dated, F.lit(0))["y"])


def works(parsed: DataFrame, site: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns and path, filename, author, title, year, ccel_url, category, source_format of walked documents."""
    none = lambda c: F.nullif(F.col(c), F.lit(""))
    author_id = F.coalesce(none("author_id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    book_id = F.coalesce(none("book_id"), F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1))
    return parsed.select(
        *keep, "path", F.regexp_replace("path", r"\.[^./]*$", ".txt").alias("filename"), creator(none("creator")).alias("author"), none("title").alias("title"), year(F.col("dates")).alias("year"),
        F.concat_ws("/", F.lit(site), author_id, book_id).alias("ccel_url"), F.lit("Other").alias("category"), F.lit("thml").alias("source_format"),
    )

